"""Measured broadcasts, spreading of inputs, session settings."""

from docweave.operators import channels as ch
from docweave.operators import docnodes as dn


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_broadcast_only_below_the_measured_size(spark):
    big = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k long, v string")
    left = spark.range(5).withColumnRenamed("id", "k")
    assert "strategy=broadcast" in _plan(left.join(ch.small(big), "k"))
    assert "strategy=broadcast" not in _plan(left.join(ch.small(big, max_bytes=10_000), "k"))


def test_small_inputs_are_spread(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, "<a/>") for i in range(10)], "doc_id long, body string") \
        .coalesce(1).write.parquet(path)
    spread = dn.spread(spark.read.parquet(path), min_partitions=4)            # one small file: one split
    assert spread.rdd.getNumPartitions() == 4
    assert sorted(r.doc_id for r in spread.collect()) == list(range(10))
    enough = spark.range(0, 20, 1, 5)
    assert "Repartition" not in _plan(dn.spread(enough, min_partitions=4))


def test_queries_leave_the_session_zone_alone(spark):
    import __spark_entry__ as E
    from .conftest import SF001
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = E.queries()["http_date_fmt"](spark, SF001).collect()
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert all(r.if_modified_since.startswith("Thu, 01 Feb 2024 00:") for r in rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
