"""Streams end in the same state as the batch plans, over several batches."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from docweave.operators.store import Store
from docweave.streaming import jobs

from .conftest import SF001


def _rows(df):
    return sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The tables as folders of part files, as a cluster writes them."""
    root = tmp_path_factory.mktemp("tables")
    for name, n in (("documents", 4), ("pages", 3)):
        spark.read.parquet(f"{SF001}/{name}.parquet").repartition(n).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name, batch", [("stream_match", "rss_match"), ("stream_upsert", "upsert_meta")])
def test_streams_over_folders_equal_the_batch(spark, folders, name, batch):
    q = E.queries()
    want = _rows(q[batch](spark, SF001))
    assert want and _rows(q[name](spark, folders)) == want == _rows(q[name](spark, SF001))


def test_counts_over_several_batches(spark, folders):
    q = E.queries()["stream_counts"]
    assert _rows(q(spark, folders)) == _rows(q(spark, SF001)) != []


def test_dedup_drops_repeats(spark, folders):
    q = E.queries()["stream_dedup"]
    keys = [r.page_key for r in q(spark, folders).collect()]
    assert len(keys) == len(set(keys)) == q(spark, SF001).count() > 0


def test_repeat_after_the_watermark_is_a_new_visit(spark, tmp_path):
    src = str(tmp_path / "in")
    for i, minute in enumerate((0, 10, 600, 601, 1300)):
        (spark.createDataFrame([("http://h/a", minute)], "url string, m int")
         .select("url", F.timestamp_add("MINUTE", "m", F.lit("2024-01-01").cast("timestamp")).alias("fetched_at"))
         .coalesce(1).write.mode("append").parquet(src))
    stream = spark.readStream.schema("url string, fetched_at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    assert jobs.run_append(jobs.stream_dedup(stream, "1 hour"), "late").count() >= 1


def test_upserts_touch_only_their_buckets_and_replays_are_idempotent(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long, t long").schema
    store = Store(spark, str(tmp_path / "store"), schema, "k", bucket_bytes=2500)
    first = spark.createDataFrame([(f"k{i}", i, 0) for i in range(300)], schema)
    for _ in range(5):                                                     # grows to several buckets
        store.upsert(first, ["t"], 1 + store.last())
    start, src = store.last(), str(tmp_path / "in")
    spark.createDataFrame([("k3", 30, 1), ("k3", 31, 2), ("new", 7, 1), (None, 1, 1)], schema).coalesce(1).write.parquet(src)
    want = {**{f"k{i}": i for i in range(300)}, "k3": 31, "new": 7}
    for _ in range(2):                                                     # the second time a replay
        store.upsert(spark.read.schema(schema).parquet(src), ["t"], start + 1)
        assert {r.k: r.v for r in store.read().collect()} == want
    same = store.manifest(start).join(store.manifest(start + 1), "path", "left_semi").count()
    assert same >= 1 and store.manifest(start).count() - same <= 2         # two keys lie in two buckets at most
    fresh = Store(spark, str(tmp_path / "other"), schema, "k")
    fresh.upsert(first, ["t"])
    out = jobs.upsert_stream(spark.readStream.schema(schema).parquet(src), fresh, ["t"])
    assert {r.k: r.v for r in out.collect()} == want and fresh.last() == 2
