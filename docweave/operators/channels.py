"""Channel sets and publish/subscribe joins.

Which channels exist when is worked out in ``history`` (J7, J10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import split_list
from ..session import written

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows, as counted and measured, take at most
    ``max_bytes``; else ``df`` unchanged (then the join shuffles and AQE splits
    skewed keys).  Only the join strategy depends on it, never the result."""
    width = F.lit(16)
    for f in df.schema:
        size = F.octet_length(f.name) if f.dataType.simpleString() in ("string", "binary") else F.lit(8)
        width = width + F.coalesce(size, F.lit(0))
    size = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= max_bytes else df


# Name rules for channels and users.
CHANNEL_NAME_RE = r"^[A-Za-z0-9]{1,20}$"
USER_NAME_RE = r"^[A-Za-z0-9]{5,16}$"


def _blank(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c)) == 0, F.lit(True))


def validate_requests(req: DataFrame) -> DataFrame:
    """F17 + F21: adds ``status`` ∈ {ok, missing_fields, invalid_channel_name,
    invalid_user_name} to channel creation requests (``channel, owner, xsl_url, xpaths``)."""
    return req.withColumn(
        "status",
        F.when(_blank(F.col("xpaths")) | _blank(F.col("channel")) | _blank(F.col("xsl_url")),
               "missing_fields")
        .when(~F.coalesce(F.col("channel").rlike(CHANNEL_NAME_RE), F.lit(False)), "invalid_channel_name")
        .when(~F.coalesce(F.col("owner").rlike(USER_NAME_RE), F.lit(False)), "invalid_user_name")
        .otherwise("ok"))


def subscriptions_of(channels: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """S3/C9 + intent of the validity filter: ``(xpath, channel)`` per channel
    expression; with ``valid`` (``xpath, valid``) invalid expressions are dropped."""
    subs = (channels.select("channel", F.explode(split_list(F.col("xpaths"))).alias("xpath"))
            .distinct())
    if valid is not None:
        subs = subs.join(valid.where("valid").select("xpath"), "xpath", "left_semi")
    return subs.select("xpath", "channel")


def purge_subscriptions(subs: DataFrame, live: DataFrame) -> DataFrame:
    """Subscriptions of channels that no longer exist are dropped."""
    return subs.join(small(live.select("channel")), "channel", "left_semi")


def channel_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(channel, change)`` with change ∈ {added, deleted} between snapshots."""
    b, a = before.select("channel").distinct(), after.select("channel").distinct()
    return (a.join(b, "channel", "left_anti").withColumn("change", F.lit("added"))
            .unionByName(b.join(a, "channel", "left_anti").withColumn("change", F.lit("deleted"))))


def fan_out(matches: DataFrame, subs: DataFrame, key: str = "doc_id") -> DataFrame:
    """J3 + A6: matches x subscriptions, one association per (key, channel)
    credited to its smallest expression.  The subscription side is broadcast
    when its counted size allows; a hot expression then costs no shuffle."""
    return (matches.join(small(subs.select("xpath", "channel")), "xpath")
            .groupBy(key, "channel").agg(F.min("xpath").alias("xpath")))


def keep_live(hits: DataFrame, live: DataFrame) -> DataFrame:
    """Associations of live channels only."""
    return hits.join(small(live.select("channel")), "channel", "left_semi")


def new_associations(hits: DataFrame, existing: DataFrame, key: str = "doc_id") -> DataFrame:
    """Associations not already recorded."""
    return hits.join(existing.select(key, "channel"), [key, "channel"], "left_anti")


def matched_any(matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """A5: documents matched by at least one expression (channels alive or not)."""
    return matches.groupBy(key).agg(F.count(F.lit(1)).alias("n_xpaths"))


def xpath_map(subs: DataFrame) -> DataFrame:
    """A1: xpath -> its channels, a row each (an expression may have any number)."""
    return subs.select("xpath", "channel").distinct()


def user_channels(channels: DataFrame) -> DataFrame:
    """A3: owner -> the owner's channels, a row each."""
    return channels.select("owner", "channel").distinct()


def channel_status(channels: DataFrame, channel_pages: DataFrame) -> DataFrame:
    """``(channel, n_pages, status)`` with status ``empty`` when no page is attached."""
    n = channel_pages.groupBy("channel").agg(F.countDistinct("url").alias("n_pages"))
    return (channels.select("channel").join(n, "channel", "left")
            .select("channel", F.coalesce("n_pages", F.lit(0)).cast("long").alias("n_pages"))
            .withColumn("status", F.when(F.col("n_pages") == 0, "empty").otherwise("ok")))


def prune_page_channels(pages: DataFrame, live: DataFrame, col: str = "channels") -> DataFrame:
    """``page.channels ∩ live channels`` as a join, not a driver-side list.

    Explodes the page's channel list, keeps live names (semi join) and regroups
    per page; pages left with no live channel get an empty array.  Pages are written
    first: they are read twice here, and may come from a match of all documents.
    """
    pages = written(pages)
    ex = pages.select("page_key", F.explode_outer(col).alias("channel"))
    kept = (ex.join(small(live.select("channel")), "channel", "left_semi")
            .groupBy("page_key").agg(F.array_sort(F.collect_set("channel")).alias("_kept")))
    return (pages.join(kept, "page_key", "left")
            .withColumn(col, F.coalesce("_kept", F.array().cast("array<string>"))).drop("_kept"))


def merge_page_channels(pages: DataFrame, gained: DataFrame, col: str = "channels") -> DataFrame:
    """U4: ``page.channels ∪ new channels`` (``gained(page_key, channel)``)."""
    g = gained.groupBy("page_key").agg(F.collect_set("channel").alias("_new"))
    return (pages.join(g, "page_key", "left")
            .withColumn(col, F.array_sort(F.array_union(
                F.coalesce(F.col(col), F.array().cast("array<string>")),
                F.coalesce("_new", F.array().cast("array<string>")))))
            .drop("_new"))
