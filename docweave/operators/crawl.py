"""The crawl run as one plan: responses to page-channel associations.

status and type filters -> robots rules -> store join -> effective body -> match ->
store upserts -> next links.  Every step is one of the operators beside this module.

Matching is by difference (F10, X4): a page whose body was fetched meets all live
channels; a page that is unmodified meets, on its stored body, only the channels that
came since the last run, and keeps what was recorded for the others.  Without new
channels no unmodified page is parsed at all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import resolve_link
from . import channels as ch
from . import fetch, recrawl, robots
from . import xpath_match as xm


class CrawlRun(NamedTuple):
    hits: DataFrame              # page_key, url, channel, how: modified, added or recorded
    meta: DataFrame              # the store after the run
    data: DataFrame
    next_links: DataFrame        # src, dst, pos for the frontier

    @property
    def associations(self) -> DataFrame:
        return self.hits.select("page_key", "url", "channel").distinct()


def visits(batch: DataFrame, meta: DataFrame, data: DataFrame, rules: DataFrame, max_bytes: int) -> DataFrame:
    """The pages of ``batch`` that may be visited, with their effective body (F9, F11):
    ``source`` is ``fetched`` or ``stored``; ``data`` is null where there is none."""
    ok = robots.allowed_pages(fetch.fetchable(fetch.status_ok(batch), max_bytes), rules)
    pages = recrawl.with_store(ok.where("page_key is not null"), meta)
    pages = pages.withColumn("modified", recrawl.modified(F.col("last_modified"), F.col("stored_access"), F.col("is_new")))
    return recrawl.effective_body(pages, data)


def _match(pages: DataFrame, subs: DataFrame, how: str) -> DataFrame:
    docs = pages.select(F.struct("page_key", "url").alias("page"), "data", F.when(F.col("type") == "html", "html").otherwise("xml").alias("kind"))
    hits = xm.match_channels(docs, subs, "page", "data", kind_col="kind")
    return hits.select("doc_id.page_key", "doc_id.url", "channel", F.lit(how).alias("how"))


def rematch(pages: DataFrame, subs: DataFrame, live: DataFrame, known: DataFrame, recorded: DataFrame) -> DataFrame:
    """Associations of ``pages`` (as of ``visits``) and those recorded before, by
    difference: ``page_key, url, channel, how``.  ``known(channel)``: the live channels
    that the last run knew as they are now."""
    held = pages.where("data is not null")
    fetched, quiet = held.where("source = 'fetched'"), held.where("source = 'stored'")
    same = live.select("channel").join(known.select("channel"), "channel", "left_semi")
    added = live.select("channel").join(known.select("channel"), "channel", "left_anti")
    hits = _match(fetched, ch.purge_subscriptions(subs, live), "modified")
    if not added.isEmpty():
        hits = hits.unionByName(_match(quiet, ch.purge_subscriptions(subs, added), "added"))
    kept = ch.keep_live(recorded.join(fetched.select("page_key").distinct(), "page_key", "left_anti"), same)
    return hits.unionByName(kept.select("page_key", "url", "channel", F.lit("recorded").alias("how")))


def crawl_run(batch: DataFrame, meta: DataFrame, data: DataFrame, rules: DataFrame, subs: DataFrame, live: DataFrame,
              known: DataFrame, recorded: DataFrame, max_bytes: int) -> CrawlRun:
    """One run over ``batch`` (classified responses with ``page_key``, ``host``, ``path``,
    ``last_modified``) against the store (``meta``, ``data``).

    ``subs(xpath, channel)``, ``live(channel)``, ``known(channel)`` as in ``rematch``;
    ``recorded(page_key, url, channel)`` are the associations so far: those of pages
    that are not fetched again stay, as far as their channels are known and live.

    Only fetched bodies go into the store; a visited page without one keeps its stored
    body, is marked as accessed, and its links are those of that body.
    """
    pages = visits(batch, meta, data, rules, max_bytes)
    hits = rematch(pages, subs, live, known, recorded)
    has_body = F.col("data").isNotNull()
    new = pages.select("page_key", "url", "type", F.col("fetched_at").alias("time_last_access"),
                       F.lit(0).cast("long").alias("crawl_delay_s"), "file_size", "encoding", F.lit(True).alias("can_crawl"),
                       F.lit(True).alias("stored"))
    fetched = pages.where((F.col("source") == "fetched") & has_body).select("page_key", "data", F.col("fetched_at").alias("time_last_access"))
    before = data.select("page_key", "data").join(meta.select("page_key", "time_last_access"), "page_key")
    data1 = recrawl.latest_wins(before, fetched, "page_key", ["time_last_access"])
    bodies = data.select("page_key").unionByName(fetched.select("page_key")).distinct().withColumn("_body", F.lit(True))
    meta1 = (recrawl.latest_wins(meta, new, "page_key", ["time_last_access"]).join(bodies, "page_key", "left")
             .withColumn("stored", F.coalesce("_body", F.lit(False))).select(*meta.columns))
    links = fetch.extract_links(pages.where(has_body), "url", "data", type_col="type")
    nexts = links.select("src", resolve_link(F.col("src"), F.col("dst"), mode="origin").alias("dst"), "pos")
    return CrawlRun(hits, meta1, data1, nexts.where("dst is not null"))
