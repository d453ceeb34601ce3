"""Registered streaming queries (T1-T4): each runs a file stream over the input
tables, one file a micro-batch, and returns what its sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import fetch
from ..operators.store import Store
from ..streaming import deferred, jobs, live
from ..sources.tables import read_table
from .derived import responses_from, rss_xml_from
from .q_crawl import PAGE_CHANNELS, STORE_CTE, TS, _HM_SQL, _page_parts, new_meta_rows, store_v0
from .q_html import PAGE_FIELDS_CTE
from .q_rss import RF_CTE, RSS_SQL, RSS_XPATHS
from .q_web import RESP_CTE, url_part_sql
from .registry import query, sql_str, values_sql


@query("stream_match", sql=RSS_SQL)
def q_stream_match(spark, sf_dir):
    """Feeds of whole documents matched as they arrive (equals the batch X4)."""
    feeds = rss_xml_from(jobs.stream_table(spark, sf_dir, "documents", 1))
    xs = spark.createDataFrame([(x,) for x, _ in RSS_XPATHS], "xpath string")
    return jobs.run_append(jobs.stream_matches(feeds, xs, "id", "xml"), "stream_match")


@query("stream_dedup", sql=f"""SELECT DISTINCT lower({url_part_sql('url', 2)}) || {url_part_sql('url', 5)} AS page_key FROM pages""")
def q_stream_dedup(spark, sf_dir):
    """Pages that arrive three times within the watermark count once."""
    r = responses_from(jobs.stream_table(spark, sf_dir, "pages", 1))
    again = F.explode(F.array(F.lit(0), F.lit(7), F.lit(19))).alias("later")
    arrivals = r.select("url", "fetched_at", again).select("url", F.timestamp_add("MINUTE", "later", "fetched_at").alias("fetched_at"))
    return jobs.run_append(jobs.stream_dedup(arrivals, "60 days"), "stream_dedup")


@query("stream_counts", sql=f"""WITH {RESP_CTE},{PAGE_FIELDS_CTE},
pch AS (SELECT * FROM {values_sql(PAGE_CHANNELS, ['xpath', 'channel'])}),
hm AS ({_HM_SQL}),
hits AS (SELECT DISTINCT pch.channel, page_id FROM hm JOIN pch USING (xpath))
SELECT h.channel, strftime(date_trunc('hour', r.fetched_at), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_docs
FROM hits h JOIN resp r USING (page_id) GROUP BY ALL""")
def q_stream_counts(spark, sf_dir):
    """Pages credited per channel per hour of their fetch time."""
    pages = responses_from(jobs.stream_table(spark, sf_dir, "pages", 1))
    subs = spark.createDataFrame(PAGE_CHANNELS, "xpath string, channel string")
    c = jobs.stream_channel_counts(pages, subs, "url", "body", "html", "fetched_at")
    return jobs.run_update(c, "stream_counts", ["channel", "window_start"])


@query("stream_upsert", sql=f"""WITH {STORE_CTE}
SELECT page_key, url, type, {TS.format('time_last_access')} AS time_last_access, file_size, stored FROM m1""")
def q_stream_upsert(spark, sf_dir):
    """T4: metadata refreshed from a response stream with foreachBatch upserts."""
    meta0, _ = store_v0(spark, sf_dir)
    store = Store(spark, jobs.new_store_path(spark, "stream_upsert"), meta0.schema, "page_key", bucket_bytes=16 << 10)
    store.upsert(meta0, ["time_last_access"])
    pages = jobs.stream_table(spark, sf_dir, "pages", 1)
    batch = _page_parts(fetch.classify(fetch.with_headers(responses_from(pages))))
    meta = jobs.upsert_stream(new_meta_rows(batch).drop("data"), store, ["time_last_access"])
    return meta.select("page_key", "url", "type",
                       dates.format_crawl_time(F.col("time_last_access")).alias("time_last_access"),
                       "file_size", "stored")


#: What users change before each file of documents comes: (action, channel, number of the
#: expression in ``RSS_XPATHS``).
LIVE_CHANGES = [
    [("add", "licences", 3), ("add", "licences", 4), ("add", "handles", 5), ("add", "first", 9)],
    [("add", "french", 8), ("add", "every", 10)],
    [("delete", "handles", None), ("delete", "every", None), ("add", "every", 6)],
]


def _live_sql() -> str:
    parts, subs = [], set()
    for b, changes in enumerate(LIVE_CHANGES):
        subs = {s for s in subs if ("delete", s[0], None) not in changes} | {(c, x) for a, c, x in changes if a == "add"}
        parts += [f"SELECT DISTINCT doc_id, {sql_str(c)} AS channel, {b + 1} AS version FROM rf WHERE doc_id % 3 = {b} AND {RSS_XPATHS[x][1]}" for c, x in sorted(subs)]
    return f"WITH {RF_CTE}\n" + "\nUNION ".join(parts)


@query("stream_match_live", sql=_live_sql())
def q_stream_match_live(spark, sf_dir):
    """T1 + J9: feeds arrive in three files; before each, users change the channels,
    while the stream runs."""
    root = jobs.new_store_path(spark, "stream_match_live")
    log = live.SubscriptionLog(spark, f"{root}/log")
    feeds = rss_xml_from(read_table(spark, sf_dir, "documents"))
    running = None
    for b, changes in enumerate(LIVE_CHANGES):
        rows = [(a, c, None if x is None else RSS_XPATHS[x][0]) for a, c, x in changes]
        log.append(spark.createDataFrame(rows, live.CHANGES))
        live.put_file(feeds.where(F.col("id") % 3 == b), f"{root}/feeds", f"part{b}")
        if running is None:
            arriving = spark.readStream.schema(feeds.schema).parquet(f"{root}/feeds")
            running = live.start_live(arriving, log, root, "id", "xml")
        running.processAllAvailable()
    running.stop()
    return live.live_rows(spark, root, "doc_id long, channel string, version int")


_MICROS = "strftime(make_timestamp({0}), '%Y-%m-%d %H:%M:%S')"


@query("stream_deferred", sql=f"""WITH {RESP_CTE},
a AS (SELECT url, lower({url_part_sql('url', 2)}) AS host, epoch_us(fetched_at) AS t FROM resp),
d AS (SELECT *, CAST(1800 * (length(host) % 5) AS BIGINT) * 1000000 AS delay, row_number() OVER (PARTITION BY host ORDER BY t, url) AS i FROM a),
v AS (SELECT *, max(t - i * delay) OVER (PARTITION BY host ORDER BY i ROWS UNBOUNDED PRECEDING) + i * delay AS visit FROM d)
SELECT host, url, {_MICROS.format('t')} AS arrived, {_MICROS.format('visit')} AS visited FROM v""")
def q_stream_deferred(spark, sf_dir):
    """pages arrive in three files, out of order; each is visited when its host's
    delay has passed.  A last row of no host that is crawled moves time on.  As each file
    may hold any time, the watermark waits as long as all arrivals span (60 days at
    least), and the last row lies behind the visits of the longest queue."""
    root = jobs.new_store_path(spark, "stream_deferred")
    pages = _page_parts(responses_from(read_table(spark, sf_dir, "pages")))
    arrivals = pages.select("page_id", "url", "host", F.col("fetched_at").alias("arrived"), (1800 * (F.length("host") % 5)).cast("long").alias("delay_s"))
    for n in range(3):
        live.put_file(arrivals.where(F.col("page_id") % 3 == n).drop("page_id"), f"{root}/arrivals", f"part{n}")
    hosts = arrivals.groupBy("host").agg(F.min("arrived").alias("first"), F.max("arrived").alias("last"), (F.count("*") * F.max("delay_s")).alias("wait_s"))
    span, wait = hosts.agg(F.datediff(F.max("last"), F.min("first")), F.ceil(F.max("wait_s") / 86400)).first()
    late = max(60, (span or 0) + 1)
    rest = max(4000, late + (wait or 0) + 1)
    end = arrivals.agg(F.lit("end").alias("url"), F.lit("").alias("host"), F.timestamp_add("DAY", F.lit(rest), F.max("arrived")).alias("arrived"), F.lit(0).cast("long").alias("delay_s"))
    stream = spark.readStream.schema(end.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arrivals")
    done = jobs.run_append(deferred.visits(stream, f"{late} days"), "stream_deferred", root=root)
    live.put_file(end, f"{root}/arrivals", "rest")
    done = jobs.run_append(deferred.visits(stream, f"{late} days"), "stream_deferred", root=root)
    shown = lambda c: dates.format_crawl_time(F.timestamp_micros(c))
    return done.select("host", "url", shown("arrived_us").alias("arrived"), shown("visited_us").alias("visited"))
