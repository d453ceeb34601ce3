"""A page store that grows, is committed whole, and is read by key.

Rows are dealt to buckets by linear hashing: the number of buckets follows the bytes
stored, and growing splits only as many buckets as it adds.  An upsert reads and writes
the buckets that its keys fall into (and those that split), as new files sorted by key.
A version is a manifest, a small table that names every live file with its bucket and
its least and greatest key; it is read only once its commit mark is there, so a version
half written is never seen, and a version written again replaces itself.

A lookup meets its keys with the manifest by bucket and key range and opens only the
files that can hold one; in them, the reader skips row groups by key statistics.

Ties: see ``recrawl.latest_wins``.  Rows without a key are not stored.  One writer at a
time.  Files that no kept version names are left to a clean-up of the folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import recrawl
from .channels import small

MANIFEST = "bucket long, path string, bytes long, low string, high string, n_buckets long"


def address(h: Column, n: int) -> Column:
    """Linear hashing: the bucket, of ``n``, of a hash.  Bucket numbers are hashes too:
    of a bucket of a larger table, this is the bucket that it came from."""
    m = 1 << (n.bit_length() - 1)                                  # the largest power of two up to n
    wide = F.pmod(h, F.lit(2 * m).cast("long"))
    return F.when(wide < n, wide).otherwise(F.pmod(h, F.lit(m).cast("long")))


class Store:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, bucket_bytes: int = 128 << 20, file_rows: int = 100_000):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.bucket_bytes, self.file_rows = bucket_bytes, file_rows

    # -- versions

    def _names(self, folder: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def last(self, below: int | None = None) -> int:
        """The newest committed version (below ``below``); 0 if there is none."""
        names = [v for v in self._names(f"{self.path}/manifest") if v.startswith("v")]
        return max((int(v[1:]) for v in names if (below is None or int(v[1:]) < below)
                    and "_SUCCESS" in self._names(f"{self.path}/manifest/{v}")), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.last() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v{version:08d}")

    def _rows(self, files: DataFrame) -> DataFrame:
        paths = [r[0] for r in files.select("path").distinct().collect()]          # of the files to be opened
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    # -- writing

    def upsert(self, new: DataFrame, order: list[str], version: int | None = None) -> int:
        """Latest-wins merge of ``new`` into the newest version before ``version``
        (default: a version more), committed as ``version``."""
        version = self.last() + 1 if version is None else version
        base = self.manifest(self.last(version)).checkpoint()
        n0, held = base.agg(F.coalesce(F.max("n_buckets"), F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        n1 = min(2 * n0, max(n0, -(-held // self.bucket_bytes)))
        rows = new.select(*self.schema.names).where(F.col(self.key).isNotNull()).checkpoint()
        touched = rows.select(address(F.xxhash64(self.key), n0).alias("bucket")).distinct()
        added = self.spark.range(n0, n1).select(address(F.col("id"), n0).alias("bucket"))        # buckets that split
        dirty = small(touched.union(added).distinct().checkpoint())
        old = self._rows(base.join(dirty, "bucket", "left_semi"))
        merged = recrawl.latest_wins(old, rows, self.key, order).select(*self.schema.names)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        (merged.withColumn("bucket", address(F.xxhash64(self.key), n1)).repartition("bucket").sortWithinPartitions("bucket", self.key)
         .write.option("maxRecordsPerFile", self.file_rows).partitionBy("bucket").parquet(folder))
        entries = self.spark.createDataFrame([], MANIFEST)
        if any(x.startswith("bucket=") for x in self._names(folder)):
            written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("bucket", T.LongType())])).parquet(folder)
            entries = written.groupBy("bucket", "_metadata.file_path", "_metadata.file_size").agg(
                F.min(self.key).alias("low"), F.max(self.key).alias("high")).select(
                "bucket", F.col("file_path").alias("path"), F.col("file_size").alias("bytes"), "low", "high", F.lit(n1).cast("long").alias("n_buckets"))
        kept = base.join(dirty, "bucket", "left_anti").withColumn("n_buckets", F.lit(n1).cast("long")).select(*entries.columns)
        kept.unionByName(entries).write.mode("overwrite").parquet(f"{self.path}/manifest/v{version:08d}")
        return version

    # -- reading by key

    def candidates(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The files that can hold a key of ``keys(key)``."""
        files = self.manifest(version)
        n = files.agg(F.coalesce(F.max("n_buckets"), F.lit(1))).first()[0]
        asked = keys.select(F.col(self.key).alias("_k")).distinct().withColumn("bucket", address(F.xxhash64("_k"), n))
        return files.join(asked, "bucket").where((F.col("_k") >= F.col("low")) & (F.col("_k") <= F.col("high"))).select("path", "bytes").distinct()

    def lookup(self, requests: DataFrame, version: int | None = None) -> DataFrame:
        """``requests`` (with the key column) joined with their stored rows."""
        return requests.join(self._rows(self.candidates(requests, version)), self.key)
