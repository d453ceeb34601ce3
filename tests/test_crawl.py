"""The crawl run over a small store, twice."""

import datetime as dt

from pyspark.sql import functions as F

from docweave.operators import crawl

T0 = dt.datetime(2024, 1, 1)


def _batch(spark, rows):
    return spark.createDataFrame(
        [(u, f"h{p}" if p else None, "h", p or "", st, ty, 10, "UTF-8", T0 + dt.timedelta(days=d), lm, b) for u, p, st, ty, d, lm, b in rows],
        "url string, page_key string, host string, path string, status string, type string, file_size long, encoding string, "
        "fetched_at timestamp, last_modified timestamp, body string")


def test_two_runs(spark):
    subs = spark.createDataFrame([("/html/body/p", "pages"), ("/r", "feeds"), ("/r/x", "late")], "xpath string, channel string")
    rules = spark.createDataFrame([("h", ["/no"])], "host string, disallows array<string>")
    meta = spark.createDataFrame([], "page_key string, url string, type string, time_last_access timestamp, crawl_delay_s long, "
                                     "file_size long, encoding string, can_crawl boolean, stored boolean")
    data = spark.createDataFrame([], "page_key string, data string")
    none = spark.createDataFrame([], "page_key string, url string, channel string")
    live = spark.createDataFrame([("pages",), ("feeds",)], "channel string")
    first = _batch(spark, [("http://h/a", "/a", "200", "html", 0, None, "<p>1<a href='b c'><a href='/n.html'>"),
                           ("http://h/f", "/f", "200", "xml", 0, None, "<r><x/></r>"), ("http://h/no", "/no", "200", "html", 0, None, "<p>2"),
                           ("http://h/e", "/e", "404", "html", 0, None, "<p>3"), ("bad", None, "200", "html", 0, None, "<p>4")])
    run = crawl.crawl_run(first, meta, data, rules, subs, live, live.where("false"), none, 100)
    one = {(r.page_key, r.channel) for r in run.associations.collect()}
    assert one == {("h/a", "pages"), ("h/f", "feeds")}
    assert {r.page_key: r.data for r in run.data.collect()} == {"h/a": "<p>1<a href='b c'><a href='/n.html'>", "h/f": "<r><x/></r>"}
    assert [(r.src, r.dst) for r in run.next_links.collect()] == [("http://h/a", "http://h/n.html")]

    again = _batch(spark, [("http://h/f", "/f", "200", "xml", 9, T0 - dt.timedelta(days=1), "<r/>")])       # not modified
    store = (run.meta.checkpoint(), run.data.drop("time_last_access").checkpoint())
    recorded = run.associations.checkpoint()
    only_feeds = spark.createDataFrame([("feeds",)], "channel string")
    quiet = crawl.crawl_run(again, *store, rules, subs, only_feeds, live, recorded, 100)
    assert {(r.page_key, r.channel, r.how) for r in quiet.hits.collect()} == {("h/f", "feeds", "recorded")}
    more = spark.createDataFrame([("feeds",), ("late",)], "channel string")
    loud = crawl.crawl_run(again, *store, rules, subs, more, live, recorded, 100)       # the new channel, on the stored body
    assert {(r.page_key, r.channel, r.how) for r in loud.hits.collect()} == {("h/f", "feeds", "recorded"), ("h/f", "late", "added")}


def test_a_page_without_a_fetched_body_keeps_its_own(spark):
    subs = spark.createDataFrame([("/html/body/p", "pages")], "xpath string, channel string")
    rules = spark.createDataFrame([("none", ["/no"])], "host string, disallows array<string>")
    meta = spark.createDataFrame([("h/a", "http://h/a", "html", T0, 0, 10, "UTF-8", True, True)], "page_key string, url string, type string, "
                                 "time_last_access timestamp, crawl_delay_s long, file_size long, encoding string, can_crawl boolean, stored boolean")
    data = spark.createDataFrame([("h/a", "<p>1<a href='/n.html'>")], "page_key string, data string")
    recorded = spark.createDataFrame([("h/a", "http://h/a", "pages")], "page_key string, url string, channel string")
    live = subs.select("channel")
    head = _batch(spark, [("http://h/a", "/a", "200", "html", 9, None, None), ("http://h/b", "/b", "200", "html", 9, None, None)])
    run = crawl.crawl_run(head, meta, data, rules, subs, live, live, recorded, 100)
    assert [(r.page_key, r.data) for r in run.data.collect()] == [("h/a", "<p>1<a href='/n.html'>")]
    assert {r.page_key: (r.stored, r.time_last_access.day) for r in run.meta.collect()} == {"h/a": (True, 10), "h/b": (False, 10)}
    assert [(r.src, r.dst) for r in run.next_links.collect()] == [("http://h/a", "http://h/n.html")]
    assert {(r.page_key, r.channel) for r in run.associations.collect()} == {("h/a", "pages")}


def test_difference_equals_the_full_run(spark):
    """Over every way in which pages and channels can change between two runs."""
    exprs = [(f"/r/{c}", f"c{i}") for i, c in enumerate("abcd")]
    subs = spark.createDataFrame(exprs, "xpath string, channel string")
    bodies = ["<r>" + "".join(f"<{c}/>" for i, c in enumerate("abcd") if n >> i & 1) + "</r>" for n in range(16)]
    old = spark.createDataFrame([(f"h/{n}", f"u{n}", b) for n, b in enumerate(bodies)], "page_key string, url string, data string")
    pages = spark.createDataFrame([(f"h/{n}", f"u{n}", "xml", "fetched" if n % 2 else "stored", bodies[15 - n] if n % 2 else bodies[n]) for n in range(16)],
                                  "page_key string, url string, type string, source string, data string")
    match = lambda df, xs: {(r.doc_id, r.channel) for r in crawl.xm.match_channels(df, xs, "page_key", "data").collect()}
    for known, live in (("01", "0123"), ("0123", "12"), ("", "03"), ("12", "12")):
        names = lambda s: spark.createDataFrame([(f"c{i}",) for i in s], "channel string")
        recorded = crawl.xm.match_channels(old, subs.join(names(known), "channel", "left_semi"), "page_key", "data").select(
            F.col("doc_id").alias("page_key"), F.col("doc_id").alias("url"), "channel")
        got = crawl.rematch(pages, subs, names(live), names(known), recorded).collect()
        assert {(r.page_key, r.channel) for r in got} == match(pages, subs.join(names(live), "channel", "left_semi"))
