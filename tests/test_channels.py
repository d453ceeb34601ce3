"""J3-J10, A1, A3, A5, U3, U4, S6, F9-F11 on small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from docweave.operators import channels as ch
from docweave.operators import history
from docweave.operators import recrawl

T0 = dt.datetime(2024, 1, 1)


def _req(spark, rows):
    return spark.createDataFrame(
        rows, "request_id long, ts timestamp, channel string, owner string, xsl_url string, xpaths string")


def test_validation_and_first_registration_wins(spark):
    req = _req(spark, [
        (1, T0, "news", "alice1", "x.xsl", "/a"),
        (2, T0, "news", "bobby2", "x.xsl", "/b"),                 # same ts: lower id wins
        (3, T0 - dt.timedelta(hours=1), "sport", "carol3", "y.xsl", "/c ; /d"),
        (4, T0, "bad-name", "dave44", "z.xsl", "/e"),
        (5, T0, "nouser", "abc", "z.xsl", "/e"),
        (6, T0, "empty", "erin55", " ", "/e"),
    ])
    valid = ch.validate_requests(req)
    taken = valid.where("status = 'ok'").withColumn("kind", F.lit("create"))
    reg = {r.request_id: r.result for r in history.outcomes(valid, history.channel_history(taken)).collect()}
    assert reg == {1: "success", 2: "association_exists", 3: "success", 4: "invalid_channel_name",
                   5: "invalid_user_name", 6: "missing_fields"}


def test_owner_deletes_purge_and_fan_out(spark):
    later = T0 + dt.timedelta(hours=1)
    requests = spark.createDataFrame(
        [(1, T0, "create", "news", "alice1"), (2, T0, "create", "sport", "carol3"),
         (9, later, "delete", "news", "bobby2"), (10, later, "delete", "sport", "carol3")],
        "request_id long, ts timestamp, kind string, channel string, owner string")
    done = history.channel_history(requests).checkpoint()
    assert {r.request_id: r.result for r in done.collect()} == {1: "success", 2: "success", 9: "not_owner", 10: "deleted"}
    live = history.live_at(history.lifetimes(done))
    subs = spark.createDataFrame([("/a", "news"), ("/b", "news"), ("/b", "sport")], "xpath string, channel string")
    assert {tuple(r) for r in ch.purge_subscriptions(subs, live).collect()} == {("news", "/a"), ("news", "/b")}
    matches = spark.createDataFrame([(1, "/a"), (1, "/b"), (2, "/b")], "doc_id long, xpath string")
    hits = ch.keep_live(ch.fan_out(matches, subs), live)
    assert {(r.doc_id, r.channel, r.xpath) for r in hits.collect()} == {(1, "news", "/a"), (2, "news", "/b")}
    assert {tuple(r) for r in ch.xpath_map(subs).collect()} == {("/a", "news"), ("/b", "news"), ("/b", "sport")}
    assert {r.doc_id: r.n_xpaths for r in ch.matched_any(matches).collect()} == {1: 2, 2: 1}


def test_diff_and_page_channel_sets(spark):
    before = spark.createDataFrame([("a",), ("b",)], "channel string")
    after = spark.createDataFrame([("b",), ("c",)], "channel string")
    assert {tuple(r) for r in ch.channel_diff(before, after).collect()} == {("c", "added"), ("a", "deleted")}
    pages = spark.createDataFrame([("k1", ["a", "b"]), ("k2", ["a"])], "page_key string, channels array<string>")
    pruned = {r.page_key: r.channels for r in ch.prune_page_channels(pages, after).collect()}
    assert pruned == {"k1": ["b"], "k2": []}
    gained = spark.createDataFrame([("k2", "c"), ("k2", "a")], "page_key string, channel string")
    merged = {r.page_key: r.channels for r in ch.merge_page_channels(pages, gained).collect()}
    assert merged == {"k1": ["a", "b"], "k2": ["a", "c"]}


def test_latest_wins_and_incremental(spark):
    old = spark.createDataFrame([("k", "v0", T0), ("j", "w0", T0)], "page_key string, v string, t timestamp")
    new = spark.createDataFrame([("k", "v1", T0 + dt.timedelta(days=1)), ("j", "w1", T0 - dt.timedelta(days=1)),
                                 ("n", "x1", T0)], "page_key string, v string, t timestamp")
    got = {r.page_key: r.v for r in recrawl.latest_wins(old, new, "page_key", ["t"]).collect()}
    assert got == {"k": "v1", "j": "w0", "n": "x1"}
    tie = spark.createDataFrame([("k", "v2", T0)], "page_key string, v string, t timestamp")
    assert recrawl.latest_wins(old, tie, "page_key", ["t"]).where("page_key = 'k'").first().v == "v2"
    same_time = [("k", f"n{i}", T0) for i in range(8)]
    for rows in (same_time, same_time[::-1], same_time[3:] + same_time[:3]):                # ties do not depend on the order
        df = spark.createDataFrame(rows, "page_key string, v string, t timestamp")
        got = recrawl.latest_wins(old, df.repartition(3), "page_key", ["t"]).where("page_key = 'k'").first().v
        first = got if rows is same_time else first
        assert got == first

    meta = spark.createDataFrame([("k", T0, True), ("j", T0, False)],
                                 "page_key string, time_last_access timestamp, stored boolean")
    batch = spark.createDataFrame([("k", T0 - dt.timedelta(days=1), "B1"), ("j", None, "B2"),
                                   ("n", None, "B3")], "page_key string, last_modified timestamp, body string")
    b = recrawl.with_store(batch, meta).withColumn(
        "modified", recrawl.modified(F.col("last_modified"), F.col("stored_access"), F.col("is_new")))
    data = spark.createDataFrame([("k", "OLD")], "page_key string, data string")
    e = {r.page_key: (r.is_new, r.modified, r.source, r.data)
         for r in recrawl.effective_body(b, data).collect()}
    assert e == {"k": (False, False, "stored", "OLD"), "j": (False, False, "fetched", "B2"),
                 "n": (True, True, "fetched", "B3")}
    assert {r.page_key for r in recrawl.to_process(b).collect()} == {"n"}
    assert {r.page_key for r in recrawl.to_process(b, True).collect()} == {"k", "j", "n"}


def test_pruned_pages_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(key):
        seen.add(1)
        return key
    pages = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, [])], "page_key long, channels array<string>")
    pages = pages.withColumn("page_key", F.udf(look, "long")("page_key"))
    live = spark.createDataFrame([("b",), ("a",)], "channel string")
    assert {r.page_key: r.channels for r in ch.prune_page_channels(pages, live).collect()} == {1: ["a", "b"], 2: [], 3: []}
    assert seen.value == 3
