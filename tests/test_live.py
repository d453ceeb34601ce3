"""Standing queries that change while the stream runs."""

import pytest
from pyspark.sql import functions as F

from docweave.streaming import jobs, live


def _log(spark, *versions):
    log = live.SubscriptionLog(spark, jobs.new_store_path(spark, "log"))
    for rows in versions:
        log.append(spark.createDataFrame(rows, live.CHANGES))
    return log


ADD = [("add", "a", "/r/a"), ("add", "b", "/r/b")]


def test_versions_of_subscriptions(spark):
    log = _log(spark, ADD, [("delete", "a", None), ("add", "a", "/r/c")], [("delete", "b", None)], [("add", "b", "/r/b"), ("delete", "x", None)])
    seen = lambda v: {tuple(r) for r in log.subscriptions(v).collect()}
    assert [seen(v) for v in range(5)] == [
        set(), {("a", "/r/a", 1), ("b", "/r/b", 1)}, {("a", "/r/c", 2), ("b", "/r/b", 1)}, {("a", "/r/c", 2)}, {("a", "/r/c", 2), ("b", "/r/b", 4)}]
    # a version without its commit mark is not read
    fs, path = jobs._file_system(spark, f"{log.path}/version=00000005/part-0.parquet")
    fs.create(path).close()
    assert log.last() == 4


@pytest.mark.parametrize("block_atoms, most_blocks", [(200_000, 16), (1, 16), (200_000, 1)])
def test_index_by_difference_equals_a_new_one(spark, block_atoms, most_blocks):
    log = _log(spark, ADD, [("add", "c", "/r/a"), ("add", "c", "/r/b")], [("delete", "a", None)], [("delete", "c", None), ("add", "c", "/r/c"), ("add", "a", "/r/a")])
    docs = spark.createDataFrame([(i, "<r>" + "".join(f"<{c}/>" for k, c in enumerate("abc") if i >> k & 1) + "</r>") for i in range(8)], "id long, xml string")
    matcher = live.LiveMatcher(log, block_atoms, most_blocks)
    for v in range(1, 5):
        matcher.advance(v)
        assert most_blocks == 1 or v > 2 or len({u for u, _ in matcher.blocks}) == v      # only what came is compiled
        got = sorted((r.doc_id, r.channel) for r in matcher.match(docs, "id", "xml", "xml").collect())
        subs = [(r.channel, r.xpath) for r in log.subscriptions(v).collect()]
        assert got == sorted({(i, c) for i in range(8) for c, x in subs if i >> "abc".index(x[-1]) & 1})


def test_a_restarted_stream_keeps_the_versions_of_its_batches(spark):
    root = jobs.new_store_path(spark, "live")
    log = _log(spark, ADD)
    docs = spark.createDataFrame([(1, "<r><a/></r>"), (2, "<r><b/></r>")], "id long, xml string")
    for n in range(2):                                   # the stream is started again for the second file
        live.put_file(docs.withColumn("id", F.col("id") + 10 * n), f"{root}/in", f"p{n}")
        running = live.start_live(spark.readStream.schema(docs.schema).parquet(f"{root}/in"), log, root, "id", "xml")
        running.processAllAvailable()
        running.stop()
        log.append(spark.createDataFrame([("delete", "a", None)], live.CHANGES))
    rows = {tuple(r) for r in live.live_rows(spark, root, "doc_id long, channel string, version int").collect()}
    assert rows == {(1, "a", 1), (2, "b", 1), (12, "b", 2)}


def test_blocks_of_a_live_index_share_one_parse(spark):
    log = _log(spark, ADD, [("add", "c", "/r/c")])
    docs = spark.createDataFrame([(1, "<r><a/><c/></r>")], "id long, xml string")
    matcher = live.LiveMatcher(log)
    matcher.advance(1)
    matcher.advance(2)
    got = matcher.match(docs, "id", "xml", "xml")
    assert len(matcher.blocks) == 2 and got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (1, "c")]
