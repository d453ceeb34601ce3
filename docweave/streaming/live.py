"""T1 + J9: channels that come and go while the documents stream.

``SubscriptionLog`` is a folder of committed versions; each holds changes: an added
(channel, expression) or a deleted channel.  ``LiveMatcher`` is a standing stream over
documents: every micro-batch is matched against the subscriptions of one version, the
newest when the batch first ran.  That number is written down before the batch is
matched, so a replay after a failure gives the same rows.

The compiled index grows by difference: a batch that meets a newer version compiles
and broadcasts only the expressions added since, as blocks of their own, and hits of
channels deleted since a block was built are dropped.  When the blocks hold more dead
than live subscriptions, or are many, they are built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import xpath_match as xm
from ..operators.channels import small
from .jobs import _file_system, _names

CHANGES = "action string, channel string, xpath string"


class SubscriptionLog:
    """Versions 1, 2, ... of a set of subscriptions in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> int:
        """The newest committed version; one without its commit mark is not read."""
        done = [v for v in _names(self.spark, self.path) if v.startswith("version=") and "_SUCCESS" in _names(self.spark, f"{self.path}/{v}")]
        return max((int(v[8:]) for v in done), default=0)

    def append(self, changes: DataFrame) -> int:
        """Commit ``changes(action, channel, xpath)``: ``delete`` rows take effect before
        the ``add`` rows of the same version.  One writer at a time."""
        version = self.last() + 1
        changes.select("action", "channel", "xpath").write.mode("overwrite").parquet(f"{self.path}/version={version:08d}")
        return version

    def changes(self, to: int) -> DataFrame:
        """All changes up to a version: ``action, channel, xpath, version``."""
        parts = [self.spark.read.schema(CHANGES).parquet(f"{self.path}/version={v:08d}").withColumn("version", F.lit(v)) for v in range(1, to + 1)]
        return xm._union(parts) if parts else self.spark.createDataFrame([], f"{CHANGES}, version int")

    def deleted(self, to: int) -> DataFrame:
        """``channel, gone``: the last version up to ``to`` that deleted it."""
        return self.changes(to).where("action = 'delete'").groupBy("channel").agg(F.max("version").alias("gone"))

    def subscriptions(self, to: int) -> DataFrame:
        """``channel, xpath, since`` as version ``to`` has them; ``since``: when they came."""
        added = self.changes(to).where("action = 'add'").groupBy("channel", "xpath").agg(F.max("version").alias("newest"), F.collect_set("version").alias("all"))
        kept = added.join(self.deleted(to), "channel", "left").where("gone is null or newest >= gone")
        after = F.filter("all", lambda v: v >= F.coalesce(F.col("gone"), F.lit(0)))
        return kept.select("channel", "xpath", F.array_min(after).alias("since"))


class LiveMatcher:
    """The index of a stream; see the module's text."""

    def __init__(self, log: SubscriptionLog, block_atoms: int = xm.BLOCK_ATOMS, most_blocks: int = 16):
        self.log, self.block_atoms, self.most_blocks = log, block_atoms, most_blocks
        self.version = 0
        self.blocks: list[tuple[int, object]] = []        # (version when built, index)
        self.compiled = 0                                 # subscriptions compiled so far, dead ones too

    def advance(self, to: int) -> None:
        if to == self.version:
            return
        live = self.log.subscriptions(to).checkpoint()
        n_live = live.count()
        fresh = live.where(F.col("since") > self.version)
        n_fresh = fresh.count()
        if to < self.version or self.compiled + n_fresh > 2 * n_live or len(self.blocks) >= self.most_blocks:
            for _, block in self.blocks:
                block.unpersist()
            self.blocks, self.compiled, fresh, n_fresh = [], 0, live, n_live
        if n_fresh:
            self.blocks += [(to, b) for b in xm.channel_blocks(fresh.select("channel", "xpath"), self.block_atoms)]
        self.compiled += n_fresh
        self.version = to

    def match(self, docs: DataFrame, id_col: str, body_col: str, kind: str, kind_col: str | None = None) -> DataFrame:
        """``doc_id, channel``: each channel once a document row."""
        src = xm._source(docs, id_col, body_col, kind, kind_col, ()).withColumn("_row", F.monotonically_increasing_id())
        gone = small(self.log.deleted(self.version).checkpoint())
        if not self.blocks:
            return src.select("doc_id", F.lit("").alias("channel")).where("false")
        built = docs.sparkSession.createDataFrame([(n, v) for n, (v, _) in enumerate(self.blocks)], "_block int, built int")
        found = xm.match_blocks(src, [b for _, b in self.blocks], "channel string").join(F.broadcast(built), "_block")
        # a channel deleted and added again later has its new expressions in a later block
        hits = found.join(gone, (found["channel"] == gone["channel"]) & (F.col("gone") > F.col("built")), "left_anti")
        return hits.select("_row", "doc_id", "channel").dropDuplicates(["_row", "channel"]).drop("_row")


def start_live(docs: DataFrame, log: SubscriptionLog, root: str, id_col: str, body_col: str, kind: str = "xml", **how):
    """Start the standing stream; its rows (``doc_id, channel, version``) go to
    ``root/out``, one folder a batch, and can be read with ``live_rows``."""
    spark = docs.sparkSession
    matcher = LiveMatcher(log)

    def batch_version(batch_id: int) -> int:
        path = f"{root}/versions/batch={batch_id:08d}"
        if "_SUCCESS" not in _names(spark, path):
            spark.range(1).select(F.lit(log.last()).alias("version")).write.mode("overwrite").parquet(path)
        return spark.read.schema("version int").parquet(path).first()[0]

    def run(batch: DataFrame, batch_id: int) -> None:
        version = batch_version(batch_id)
        matcher.advance(version)
        hits = matcher.match(batch, id_col, body_col, kind, **how)
        hits.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{root}/out/v={batch_id:08d}")

    return docs.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/_ck").start()


def live_rows(spark: SparkSession, root: str, schema) -> DataFrame:
    """What the batches have written so far."""
    done = [v for v in _names(spark, f"{root}/out") if "_SUCCESS" in _names(spark, f"{root}/out/{v}")]
    return spark.read.schema(schema).parquet(*(f"{root}/out/{v}" for v in done)) if done else spark.createDataFrame([], schema)


def put_file(df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` beside a streamed folder and move its files in (a rename each), as a
    writer that streams can watch does."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{folder}-staged/{name}")
    fs, staged = _file_system(spark, f"{folder}-staged/{name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    for i, f in enumerate(n for n in _names(spark, f"{folder}-staged/{name}") if n.endswith(".parquet")):
        fs.rename(path(f"{folder}-staged/{name}/{f}"), path(f"{folder}/{name}-{i}.parquet"))
