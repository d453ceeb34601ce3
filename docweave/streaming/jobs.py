"""Channels as standing queries over arriving documents.

Sources are file streams (``readStream`` with an explicit schema); sinks are
fault-tolerant: an append file sink or an idempotent ``foreachBatch`` writing
into the shared checkpoint folder (``spark.checkpoint.dir``), each with its own
checkpoint location, so a lost executor or a restarted query replays without
duplicates.  Documents stream whole and are matched inside their row (X12): no
stream state and no static table is needed for it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import xpath_match as xm
from ..operators.store import Store
from ..session import ensure_checkpoint_dir
from ..sources.tables import TABLE_SCHEMAS


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over the table ``<sf_dir>/<name>.parquet``: a folder of part files,
    or files whose names start with it."""
    r = spark.readStream.schema(TABLE_SCHEMAS[name]).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    fs, path = _file_system(spark, f"{sf_dir}/{name}.parquet")
    if fs.exists(path) and fs.getFileStatus(path).isDirectory():
        return r.load(f"{sf_dir}/{name}.parquet")
    return r.option("pathGlobFilter", f"{name}*.parquet").load(sf_dir)


def _scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_append(df: DataFrame, name: str, partition_cols: list[str] | None = None, root: str | None = None) -> DataFrame:
    """Run a stream to completion (``availableNow``) into a parquet file sink
    and return the sink as a batch DataFrame.  With the ``root`` of a run before, the
    stream goes on from where that ended."""
    spark = df.sparkSession
    root = root or _scratch(spark, name)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.start(f"{root}/out").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def run_update(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an aggregating stream in ``update`` mode.  Every micro-batch writes the rows
    that changed into its own folder (a replay rewrites it); the result is the last row
    of each key."""
    spark = df.sparkSession
    root = _scratch(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/out/v={batch_id}")

    (df.writeStream.outputMode("update").foreachBatch(write)
     .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start().awaitTermination())
    if not _names(spark, f"{root}/out"):
        return spark.createDataFrame([], df.schema)
    rest = [c for c in df.columns if c not in keys]
    rows = spark.read.parquet(f"{root}/out")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("r"))
    return last.select(*keys, "r.*").select(*df.columns)


# --- the standing queries ---------------------------------------------------------

def stream_matches(docs: DataFrame, xpaths: DataFrame, id_col: str, body_col: str, kind: str = "xml") -> DataFrame:
    """Documents as they arrive -> ``(doc_id, xpath)``."""
    return xm.match_documents(docs, xpaths, id_col, body_col, kind)


def stream_channel_counts(docs: DataFrame, subs: DataFrame, id_col: str, body_col: str, kind: str,
                          event_time: str, window: str = "1 hour", watermark: str = "30 days") -> DataFrame:
    """Documents credited per channel per tumbling event-time window.  Channels
    are resolved inside each document row, so the only state is the count of windows
    that the watermark has not passed."""
    hits = xm.match_channels(docs, subs, id_col, body_col, kind, keep=[event_time])
    return (hits.withWatermark(event_time, watermark)
            .groupBy(F.window(event_time, window), "channel")
            .agg(F.count(F.lit(1)).alias("n_docs"))
            .select("channel", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "n_docs"))


def stream_dedup(arrivals: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeats of a page key that come within the watermark of the first.
    ``arrivals(url, fetched_at)``; a repeat later than that counts as a new visit."""
    from ..functions.urls import page_key
    r = arrivals.select(page_key(F.col("url")).alias("page_key"), "fetched_at")
    return (r.withWatermark("fetched_at", watermark)
            .dropDuplicatesWithinWatermark(["page_key"]).select("page_key"))


# --- T4: upserts into a store ---------------------------------------------------------

def upsert_stream(new_rows: DataFrame, store: Store, order: list[str]) -> DataFrame:
    """T4: ``foreachBatch`` latest-wins upsert into a store that was written once
    (version 1).  Batch b commits version b + 2 on top of the newest version before it, so
    a replayed batch replaces its own version.  Returns the store as it ends."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, order, batch_id + 2)

    (new_rows.writeStream.foreachBatch(merge)
     .option("checkpointLocation", f"{store.path}/_ck").trigger(availableNow=True)
     .start().awaitTermination())
    return store.read()


def _names(spark: SparkSession, root: str) -> list[str]:
    """Names in a folder, sorted (Hadoop file system API)."""
    fs, path = _file_system(spark, root)
    return sorted(st.getPath().getName() for st in fs.listStatus(path)) if fs.exists(path) else []


def new_store_path(spark: SparkSession, name: str) -> str:
    return _scratch(spark, name)
