"""Incremental re-processing against a page store.

The store is two tables keyed by ``page_key`` (``page_meta``, ``page_data``)
and one keyed by ``host`` (``robots``).  Upserts are latest-wins hash
aggregates (``max_by`` over an ordering struct) over ``existing ∪ new``, so a
hot key costs one row per task after the map-side partial aggregate; the
result is written back as a whole table (overwrite of a new version).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import page_key


def latest_wins(existing: DataFrame, new: DataFrame, key: str,
                order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` struct.

    ``new`` rows are preferred on ties (``_src`` = 1 sorts after 0), then the row whose
    hash is greatest, so the outcome does not depend on the order of the input.  Rows
    without a key (malformed urls) belong to no page: see ``without_key``.
    """
    cols = existing.columns
    both = (existing.select(*cols).withColumn("_src", F.lit(0))
            .unionByName(new.select(*cols).withColumn("_src", F.lit(1))))
    ordering = F.struct(*[F.col(c) for c in order], F.col("_src"), F.xxhash64(*cols), F.hash(*cols))
    row = F.struct(*[F.col(c) for c in cols if c != key])
    return (both.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, ordering).alias("_r"))
            .select(key, "_r.*"))


def without_key(rows: DataFrame, key: str = "page_key") -> DataFrame:
    """The rows that an upsert cannot place: their key is null."""
    return rows.where(F.col(key).isNull())


def lookup(store: DataFrame, requests: DataFrame, url: str = "url") -> DataFrame:
    """Store rows for request URLs (key derived from the URL); misses dropped."""
    req = requests.withColumn("page_key", page_key(F.col(url)))
    return req.join(store, "page_key")


def with_store(batch: DataFrame, meta: DataFrame) -> DataFrame:
    """Fetched rows left-joined with their stored metadata; ``is_new`` when absent."""
    m = meta.select("page_key", F.col("time_last_access").alias("stored_access"),
                    F.col("stored").alias("was_stored"), F.lit(True).alias("_known"))
    return (batch.join(m, "page_key", "left")
            .withColumn("is_new", F.col("_known").isNull()).drop("_known"))


def modified(last_modified: Column, stored_access: Column, is_new: Column) -> Column:
    """modified when Last-Modified is after the stored access time, or new.
    An unparseable or absent date counts as the epoch (never modified)."""
    lm = F.coalesce(last_modified, F.lit("1970-01-01 00:00:00").cast("timestamp"))
    return is_new | F.coalesce(lm > stored_access, F.lit(False))


def to_process(df: DataFrame, channel_added: Column | bool = False) -> DataFrame:
    """pages to (re)match: modified, or every page when a channel was added.
    Skipped pages still expand links (keep using ``df`` for that)."""
    flag = F.lit(channel_added) if isinstance(channel_added, bool) else channel_added
    return df.where(F.col("modified") | flag)


def effective_body(df: DataFrame, data: DataFrame) -> DataFrame:
    """fetch when modified or not stored; otherwise reuse stored data.

    Adds ``source`` ∈ {fetched, stored} and ``data``; rows whose stored copy
    is missing get null data (not matched).
    """
    fetch = F.col("modified") | ~F.coalesce(F.col("was_stored"), F.lit(False))
    d = data.select("page_key", F.col("data").alias("_stored"))
    return (df.join(d, "page_key", "left")
            .withColumn("source", F.when(fetch, "fetched").otherwise("stored"))
            .withColumn("data", F.when(fetch, F.col("body")).otherwise(F.col("_stored")))
            .drop("_stored"))
