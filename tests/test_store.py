"""The store: growth, commits, ties, lookups by key."""

import random

from pyspark.sql import functions as F

from docweave.operators.store import Store, address
from docweave.streaming import jobs

SCHEMA = "k string, t long, v string"


def _store(spark, **how):
    return Store(spark, jobs.new_store_path(spark, "store"), spark.createDataFrame([], SCHEMA).schema, "k", **how)


def test_addresses_of_linear_hashing(spark):
    h = spark.range(4000).select(F.xxhash64("id").alias("h"))
    for n in (1, 3, 4, 7):
        got = h.select("h", address(F.col("h"), n).alias("b"))
        assert {r.b for r in got.select("b").distinct().collect()} == set(range(n))
        for more in {n, n + 1, 2 * n}:                                # a bucket tells the one it came from
            assert got.withColumn("c", address(F.col("h"), more)).where(address(F.col("c"), n) != F.col("b")).isEmpty()


def test_upserts_grow_and_equal_a_dictionary(spark):
    rng = random.Random(7)
    store, want, buckets = _store(spark, bucket_bytes=2500, file_rows=30), {}, []
    for version in range(1, 5):
        rows = [(f"k{rng.randint(0, 400)}", rng.randint(0, 9) + 2 * version, f"v{version}" + "x" * 40) for _ in range(150)]
        store.upsert(spark.createDataFrame([*rows, (None, 1, "no key")], SCHEMA), ["t"])
        for k, t, v in rows:
            if k not in want or t >= want[k][0]:
                want[k] = (t, v)
        m = store.manifest()
        buckets.append(m.first().n_buckets)
        assert {r.k: (r.t, r.v) for r in store.read().collect()} == want
        assert m.count() == m.select("path").distinct().count()
    assert buckets[0] == 1 and buckets[-1] > 3 and buckets == sorted(buckets)
    # an older version is still whole
    assert store.read(1).count() <= store.read(2).count() <= len(want)


def test_a_half_written_version_is_not_read_and_a_replay_replaces_its_own(spark):
    store = _store(spark)
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    store.upsert(rows(("a", 1, "x"), ("b", 1, "y")), ["t"])
    fs, p = jobs._file_system(spark, f"{store.path}/manifest/v00000002/part-0.parquet")
    fs.create(p).close()
    assert store.last() == 1 and store.read().count() == 2
    for _ in range(2):
        assert store.upsert(rows(("a", 2, "z"), ("c", 1, "w")), ["t"], 2) == 2
    assert {tuple(r) for r in store.read().collect()} == {("a", 2, "z"), ("b", 1, "y"), ("c", 1, "w")}


def test_a_lookup_opens_few_files(spark):
    store = _store(spark, bucket_bytes=2000, file_rows=20)
    df = spark.range(1200).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("k"), F.col("id").alias("t"), F.lit("v").alias("v"))
    for _ in range(3):
        store.upsert(df.withColumn("t", F.col("t") + 1), ["t"])
    assert store.manifest().count() > 50
    for n in (0, 20):
        asked = spark.range(n).select(F.concat(F.lit("key"), (F.col("id") * 7).cast("string")).alias("k"))
        asked = asked.union(spark.createDataFrame([("none",), (None,)], "k string"))
        assert {r.k for r in store.lookup(asked).collect()} == {f"key{i * 7}" for i in range(n)}
        assert store.candidates(asked).count() <= n + 1       # a file for each key


def test_an_empty_store(spark):
    store = _store(spark)
    assert store.read().count() == 0 and store.lookup(spark.createDataFrame([("a",)], "k string")).count() == 0
    store.upsert(spark.createDataFrame([], SCHEMA), ["t"])
    assert store.last() == 1 and store.read().count() == 0
