"""Spark BFS against a brute-force FIFO crawl."""

from collections import deque

from pyspark.sql import functions as F

from docweave.operators import frontier
from docweave.plans.q_crawl import lineitem_links

from .conftest import SF001


def brute_bfs(edges, seeds, max_depth):
    out = {}
    for s in sorted(edges):
        edges[s].sort(key=lambda e: e[1])
    q = deque((s, 0) for s in seeds)
    order = []
    while q:
        n, d = q.popleft()
        if n in out:
            continue
        out[n] = d
        order.append(n)
        if max_depth is None or d < max_depth:
            for dst, _pos in edges.get(n, []):
                q.append((dst, d + 1))
    return out, order


def test_reach_and_budget_match_fifo_queue(spark):
    links = lineitem_links(spark, SF001)
    rows = links.collect()
    edges = {}
    for r in rows:
        edges.setdefault(r.src, []).append((r.dst, r.pos))
    seeds = ["s1", "s2"]
    depth, order = brute_bfs(edges, seeds, 3)
    sdf = spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "url string, pos long")
    reached = frontier.crawl_reach(links, sdf, 3)
    got = {r.url: r.depth for r in reached.collect()}
    assert got == depth
    budget = frontier.crawl_budget(reached, 40).orderBy("visit_rank").collect()
    assert [r.url for r in budget] == order[:40]
    assert [r.visit_rank for r in budget] == list(range(1, 41))


def test_visit_key_dedup(spark):
    links = spark.createDataFrame([("http://h/", "http://h/a", 0), ("http://h/", "https://h/a", 1),
                                   ("http://h/a", "http://h/b", 0)], "src string, dst string, pos long")
    seeds = spark.createDataFrame([("http://h/",)], "url string")
    from docweave.functions.urls import visit_key
    r = frontier.crawl_reach(links, seeds, 5, visit_key=visit_key)
    assert sorted((x.url, x.depth) for x in r.collect()) == [
        ("http://h/", 0), ("http://h/a", 1), ("http://h/b", 2)]


def brute_bfs_redirects(edges, redirects, seeds, max_depth):
    """FIFO queue; a redirect target goes to the front, same depth; a
    redirecting page has no links."""
    out, order = {}, []
    q = deque((s, 0) for s in seeds)
    while q:
        n, d = q.popleft()
        if n in out:
            continue
        out[n] = d
        order.append(n)
        if n in redirects:
            q.appendleft((redirects[n], d))
            continue
        if max_depth is None or d < max_depth:
            for dst, _pos in sorted(edges.get(n, []), key=lambda e: e[1]):
                q.append((dst, d + 1))
    return out, order


def test_redirects_jump_the_queue(spark):
    links = lineitem_links(spark, SF001)
    edges = {}
    for r in links.collect():
        edges.setdefault(r.src, []).append((r.dst, r.pos))
    parts = sorted({d for v in edges.values() for d, _ in v if d.startswith("p")})
    redirects = {p: f"p{int(p[1:]) + 1}" for p in parts if int(p[1:]) % 10 == 0}
    seeds = ["s1", "s2"]
    depth, order = brute_bfs_redirects(edges, redirects, seeds, 3)
    rdf = spark.createDataFrame(list(redirects.items()), "src string, dst string")
    sdf = spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "url string, pos long")
    reached = frontier.crawl_reach(links, sdf, 3, redirects=rdf)
    assert {r.url: r.depth for r in reached.collect()} == depth
    budget = frontier.crawl_budget(reached, 60).orderBy("visit_rank").collect()
    assert [r.url for r in budget] == order[:60]


def _frames(spark, links, seeds, redirects=None):
    return (spark.createDataFrame([(a, b, p) for a, out in links.items() for b, p in out], "src string, dst string, pos long"),
            spark.createDataFrame([(s, i) for i, s in enumerate(seeds)], "url string, pos long"),
            None if redirects is None else spark.createDataFrame(list(redirects.items()), "src string, dst string"))


def _order(reached):
    return [r.url for r in frontier.crawl_budget(reached, -1).orderBy("visit_rank").collect()]


def test_long_chains_same_level_targets_and_large_positions(spark):
    links = {"s": [("a", 3), ("b", 20_000_000_001), ("c", 3_000_000_000), ("r0", 4)], "r7": [("z", 0)], "z": [("y", 0)]}
    redirects = {"a": "c", **{f"r{i}": f"r{i + 1}" for i in range(7)}, "y": "a"}
    e, s, r = _frames(spark, links, ["s"], redirects)
    reached = frontier.crawl_reach(e, s, redirects=r)
    _, order = brute_bfs_redirects({k: [*v] for k, v in links.items()}, redirects, ["s"], 99)
    assert _order(reached) == order == ["s", "a", "c", *[f"r{i}" for i in range(8)], "b", "z", "y"]


def test_random_graphs_with_redirects_match_the_queue(spark):
    import random
    for seed in range(2):
        rng = random.Random(seed)
        names = [f"n{i}" for i in range(24)]
        redirects = {n: rng.choice(names) for n in rng.sample(names, 8)}
        links = {n: [(rng.choice(names), p) for p in range(rng.randint(0, 3))] for n in names}
        e, s, r = _frames(spark, links, ["n0", "n1"], redirects)
        depth, order = brute_bfs_redirects(links, redirects, ["n0", "n1"], 99)
        reached = frontier.crawl_reach(e, s, redirects=r)
        assert _order(reached) == order
        assert {x.url: x.depth for x in reached.collect()} == depth


def test_budget_counts_successful_pages_and_ends_the_crawl(spark):
    links = {f"n{i}": [(f"n{2 * i + 1}", 0), (f"n{2 * i + 2}", 1)] for i in range(60)}
    e, s, _ = _frames(spark, links, ["n0"])
    ok = ~F.col("url").endswith("3")
    reached = frontier.crawl_reach(e, s, budget=9, fetchable=ok)
    assert 14 < reached.count() < 60                         # ends with the level that fills the budget
    got = [r.url for r in frontier.crawl_budget(reached, 9, ok).orderBy("visit_rank").collect()]
    assert got == [f"n{i}" for i in range(60) if i % 10 != 3][:9]


def test_ranks_need_no_single_partition(spark):
    rows = spark.range(1000).select(F.col("id").alias("url"), F.lit(0).alias("depth"), (F.col("id") * 7919 % 1000).alias("order_key"),
                                    F.col("id").alias("vkey"))
    out = frontier.crawl_budget(rows, -1)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.order_key for r in out.orderBy("visit_rank").collect()] == list(range(1000))
    assert frontier.crawl_budget(rows.where("false"), -1).count() == 0


def test_redirect_order_query(spark):
    import __spark_entry__ as E
    links = lineitem_links(spark, SF001)
    edges = {}
    for r in links.collect():
        edges.setdefault(r.src, []).append((r.dst, r.pos))
    redirects = {d: f"p{int(d[1:]) + 1}" for v in edges.values() for d, _ in v if d[0] == "p" and int(d[1:]) % 10 < 8}
    _, order = brute_bfs_redirects(edges, redirects, ["s1", "s2"], 99)
    got = sorted((r.visit_rank, r.url) for r in E.queries()["crawl_redirect_order"](spark, SF001).collect())
    assert [u for _, u in got] == order


def test_links_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(pos):
        seen.add(1)
        return pos
    edges = [(f"n{i}", f"n{i + 1}", i) for i in range(6)]
    links = spark.createDataFrame(edges, "src string, dst string, pos long").withColumn("pos", F.udf(look, "long")("pos"))
    reached = frontier.crawl_reach(links, spark.createDataFrame([("n0",)], "url string"))
    assert reached.count() == 7 and seen.value == 6


def test_large_levels_are_shuffled_to_the_same_result(spark, monkeypatch):
    edges = [(f"n{i}", f"n{j}", j) for i in range(30) for j in ((i * 2 + 1) % 30, (i * 3 + 2) % 30)]
    redirects = spark.createDataFrame([("n4", "n5"), ("n5", "n6"), ("n9", "n1")], "src string, dst string")
    links = spark.createDataFrame(edges, "src string, dst string, pos long")
    seeds = spark.createDataFrame([("n0",), ("n7",)], "url string")
    run = lambda: sorted(map(tuple, frontier.crawl_reach(links, seeds, redirects=redirects).collect()))
    small = run()
    monkeypatch.setattr(frontier, "BROADCAST_BYTES", -1)
    assert run() == small and len(small) > 10
