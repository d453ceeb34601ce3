"""Pages that wait for their host come back in time."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.streaming import deferred, jobs, live

T0 = dt.datetime(2024, 1, 1)


def plain(pages, delay):
    out, last = [], None
    for arrived, url in sorted(pages):
        last = arrived if last is None else max(arrived, last + delay)
        out.append((url, arrived, last))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.text("abc", min_size=1, max_size=2)), max_size=15), st.integers(0, 9), st.lists(st.integers(0, 200), max_size=5))
def test_waking_more_often_changes_nothing(pages, delay, wakes):
    last, queue, got = None, sorted(pages), []
    for now in [*sorted(wakes), 10_000]:
        visits, last, queue, due = deferred.settle(last, queue, delay, now)
        got += visits
        assert all(v < now for _, _, v in visits) and (due is None) == (not queue) and (due is None or due >= now)
    assert got == plain(pages, delay) and not queue


def test_visits_do_not_depend_on_batches(spark):
    rng = random.Random(4)
    rows = [(f"u{i}", rng.choice(["hot", "hot", "b", "c"]), T0 + dt.timedelta(seconds=rng.randint(0, 3000)), 30) for i in range(120)]
    rows += [(None, "b", T0, 1), ("x", None, T0, 1), ("y", "b", None, 1)]
    schema = "url string, host string, arrived timestamp, delay_s long"
    want = {}
    for host in "hot", "b", "c":
        for url, a, v in plain([(int((t - T0).total_seconds()), u) for u, h, t, _ in rows if h == host and u and t], 30):
            want[url] = (host, a, v)
    for n in (1, 4):
        root = jobs.new_store_path(spark, "deferred")
        df = spark.createDataFrame(rows, schema)
        for b in range(n):
            live.put_file(df.where(F.pmod(F.xxhash64("url"), F.lit(n)) == b).coalesce(1), f"{root}/in", f"p{b}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        first = jobs.run_append(deferred.visits(stream, "1 hours"), "deferred", root=root)
        assert first.count() == 0                                   # time has not moved on far enough
        live.put_file(spark.createDataFrame([("end", "z", T0 + dt.timedelta(days=2), 0)], schema), f"{root}/in", "rest")
        done = jobs.run_append(deferred.visits(stream, "1 hours"), "deferred", root=root)
        zero = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
        assert {r.url: (r.host, r.arrived_us // 10**6 - zero, r.visited_us // 10**6 - zero) for r in done.collect()} == want


def test_a_queue_that_is_served_in_part_waits_on(spark):
    schema = "url string, host string, arrived timestamp, delay_s long"
    root = jobs.new_store_path(spark, "deferred")
    rows = [(f"u{i}", "h", T0 + dt.timedelta(seconds=i), 7200) for i in range(6)]
    for b, more in enumerate((rows, [("w", "z", T0 + dt.timedelta(hours=5), 0)], [("end", "z", T0 + dt.timedelta(days=2), 0)])):
        live.put_file(spark.createDataFrame(more, schema).coalesce(1), f"{root}/in", f"p{b}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        done = jobs.run_append(deferred.visits(stream, "1 hours"), "deferred", root=root)
    zero = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    assert {r.url: r.visited_us // 10**6 - zero for r in done.where("host = 'h'").collect()} == {f"u{i}": 7200 * i for i in range(6)}


def test_pages_of_more_than_the_watermark_are_all_visited(spark, tmp_path):
    import __spark_entry__ as E
    rows = [(i * 30_000, f"http://h{i % 2}.example.com/{i}", "<p>x</p>") for i in range(12)]     # 20 days apart
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = E.queries()["stream_deferred"](spark, str(tmp_path))
    assert sorted(r.url for r in got.collect()) == sorted(r[1] for r in rows)
