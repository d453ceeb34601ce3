"""Breadth-first reach over a link graph.

One level at a time, until no page is new: frontier ⋈ links, the first occurrence of
every target (a ``min`` that is aggregated before the shuffle, so a page that a third
of all links point to is no hot key), then the pages not visited before.  The links are
written once, in front of the first level; every level is written once, and what was
visited is the union of the levels.  Levels that are small, as counted and measured, are
broadcast, so that a level moves its own links and not all links of the graph.

Visit order (I2) is an array key: a page's key is its parent's key plus its position
on the parent page, so ``(depth, key)`` orders pages as a FIFO queue pops them.  A
redirect target is put in front of the queue: its key is the redirecting page's key
plus -1, and a page that is reached both ways keeps the smaller key.  Redirect chains
are resolved once, by doubling; a level then follows them in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

COLUMNS = ["url", "depth", "vkey", "order_key"]


def _key(pos: Column) -> Column:
    return F.array(F.coalesce(pos.cast("long"), F.lit(0)))


def _first(candidates: DataFrame) -> DataFrame:
    """``vkey, order_key, url`` of the first occurrence of every visit key."""
    return (candidates.groupBy("vkey").agg(F.min(F.struct("order_key", "url")).alias("f"))
            .select("vkey", "f.order_key", "f.url"))


#: Bytes of a level that is broadcast, at most.
BROADCAST_BYTES = 64 << 20


def _measured(level: DataFrame) -> tuple[int, int]:
    """Rows of a level and about their bytes in memory."""
    text = F.octet_length("url") + F.coalesce(F.octet_length(F.col("vkey").cast("string")), F.lit(0))
    return level.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(text, F.lit(0)) + 8 * F.size("order_key") + 96), F.lit(0))).first()


def _near(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _new(candidates: DataFrame, visited: list[tuple[DataFrame, int, int]]) -> DataFrame:
    for level, _, size in visited:
        candidates = candidates.join(_near(level.select("vkey"), size), "vkey", "left_anti")
    return candidates


def _merged(levels: list[tuple[DataFrame, int, int]]) -> list[tuple[DataFrame, int, int]]:
    """Equal-sized runs of levels are merged like binary digits, so that many small
    levels stay few tables and a row is rewritten a logarithmic number of times."""
    levels = [*levels]
    while len(levels) > 1 and levels[-1][1] >= levels[-2][1]:
        (a, n, x), (b, m, y) = levels.pop(), levels.pop()
        levels.append((written(b.unionByName(a)), n + m, x + y))
    return levels


#: Hops of a redirect chain that one join follows.
HOPS = 32


def redirect_closure(redirects: DataFrame, hops: int = HOPS) -> DataFrame:
    """``src, dst, hops``: every page up to ``hops`` redirects behind a page, at its
    least number of hops.  Chains are resolved by doubling, in log2(hops) rounds at most,
    for all pages at once; a cycle ends where it comes round."""
    known = redirects.select("src", "dst").where("src <> dst").distinct().withColumn("hops", F.lit(1))
    known = written(known)
    n, reach = known.count(), 1
    while reach < hops:
        far = known.where(F.col("hops") == reach).select(F.col("src").alias("first"), F.col("dst").alias("src"))
        more = far.join(known, "src").select(F.col("first").alias("src"), "dst", (F.col("hops") + reach).alias("hops"))
        known = written(known.unionByName(more.where(F.col("hops") <= hops)).where("src <> dst")
                        .groupBy("src", "dst").agg(F.min("hops").alias("hops")))
        m, n = n, known.count()
        if m == n:
            break
        reach *= 2
    return known


class _Redirects:
    """Redirects as their closure; ``longer``: whether chains go on behind it."""

    def __init__(self, redirects: DataFrame):
        self.closure = redirect_closure(redirects)
        ends = self.closure.where(F.col("hops") == HOPS).select(F.col("dst").alias("src"))
        self.longer = not ends.join(self.closure.select("src"), "src", "left_semi").isEmpty()

    def follow(self, level: DataFrame, size: int, visited: list[tuple[DataFrame, int, int]], vk) -> DataFrame:
        """Add the targets of redirecting pages to a level.  Keys only fall, so further
        rounds, which only chains beyond ``HOPS`` need, end where nothing falls any more.
        (What lies behind a page visited before was visited with it.)"""
        moves = self.closure.select(F.col("src").alias("url"), F.col("dst").alias("to"), "hops")
        changed = level
        while True:
            found = _near(changed, size).join(moves, "url").select(
                F.col("to").alias("url"), F.concat("order_key", F.array_repeat(F.lit(-1).cast("long"), F.col("hops"))).alias("order_key"))
            targets = _new(_first(found.withColumn("vkey", vk(F.col("url")))), visited).select("vkey", "order_key", "url")
            if not self.longer:
                return written(_first(level.unionByName(targets)))
            old = level.select("vkey", F.col("order_key").alias("old"))
            changed = written(targets.join(old, "vkey", "left").where("old is null or order_key < old")
                              .select("vkey", "order_key", "url"))
            n, size = _measured(changed)
            if n == 0:
                return level
            level = written(_first(level.unionByName(changed)))


def crawl_reach(links: DataFrame, seeds: DataFrame, max_depth: int | None = None, visit_key=None,
                redirects: DataFrame | None = None, budget: int = -1, fetchable: Column | None = None,
                pages: DataFrame | None = None) -> DataFrame:
    """Reachable pages: ``url, depth, vkey, order_key``.

    ``links(src, dst, pos)``; ``seeds(url)`` in ``pos`` order if present.  ``visit_key``
    maps a URL column to the column that tells visited pages (default: the URL).
    ``redirects(src, dst)``: a redirecting page has no links and its target jumps the
    queue.  The crawl runs until the frontier is empty (``max_depth=None``) or, with a
    ``budget``, until the levels hold that many successful pages: those where
    ``fetchable`` holds on the row joined with ``pages(url, ...)``.
    """
    vk = visit_key or (lambda c: c)
    edges = links.select("src", "dst", "pos")
    if redirects is not None:   # a redirect response carries no links
        edges = edges.join(redirects.select("src").distinct(), "src", "left_anti")
    edges = written(edges)
    pos = F.col("pos") if "pos" in seeds.columns else F.lit(0)
    jumps = None if redirects is None else _Redirects(redirects)
    level = written(_first(seeds.select("url", _key(pos).alias("order_key")).withColumn("vkey", vk(F.col("url")))))
    visited: list[tuple[DataFrame, int, int]] = []
    depth, found = 0, 0
    while True:
        n, size = _measured(level)
        if jumps is not None and n:
            level = jumps.follow(level, size, visited, vk)
            n, size = _measured(level)
        if n == 0:
            break
        visited = _merged([*visited, (level.withColumn("depth", F.lit(depth)).select(*COLUMNS), n, size)])
        if budget >= 0:
            found += successful(level, fetchable, pages).count()
        if depth == max_depth or 0 <= budget <= found:
            break
        depth += 1
        front = level.select(F.col("url").alias("src"), F.col("order_key").alias("parent"))
        # a frontier beyond that is shuffled; AQE splits sources with many links
        found_links = edges.join(_near(front, size), "src").select(
            F.col("dst").alias("url"), F.concat("parent", _key(F.col("pos"))).alias("order_key"))
        candidates = _first(found_links.withColumn("vkey", vk(F.col("url"))))
        level = written(_new(candidates, visited).select("vkey", "order_key", "url"))
    out = visited[0][0]
    for more, _, _ in visited[1:]:
        out = out.unionByName(more)
    return out


def successful(rows: DataFrame, fetchable: Column | None, pages: DataFrame | None) -> DataFrame:
    """Rows whose page was downloaded: ``fetchable`` on the row and its ``pages`` row."""
    if pages is not None:
        rows = rows.join(pages, "url", "left")
    return rows if fetchable is None else rows.where(F.coalesce(fetchable, F.lit(False)))


def ranked(rows: DataFrame, order: list[str], rank: str, partitions: int | None = None) -> DataFrame:
    """``rows`` plus their 1-based place in ``order``, without a task that holds them
    all: range partitions are sorted and written, and each adds the number of rows in
    those before it (one number a partition comes to the driver)."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint()
    place = parts.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_i"))
    sizes = place.groupBy("_p").agg(F.count("*").alias("n")).collect()
    starts, total = {}, 0
    for p, size in sorted((r["_p"], r["n"]) for r in sizes):
        starts[p], total = total, total + size
    if not starts:
        return rows.select("*", F.lit(0).cast("long").alias(rank))
    before = F.element_at(F.create_map(*(F.lit(x) for kv in starts.items() for x in kv)), F.col("_p"))
    inside = F.col("_i").bitwiseAND((1 << 33) - 1)
    return place.select(*rows.columns, (before + inside + 1).cast("long").alias(rank))


def crawl_budget(reached: DataFrame, budget: int, fetchable: Column | None = None,
                 pages: DataFrame | None = None) -> DataFrame:
    """L1: the first ``budget`` successful visits in queue order (-1 = all), with
    ``visit_rank``."""
    out = ranked(successful(reached, fetchable, pages).select(*COLUMNS), ["depth", "order_key"], "visit_rank")
    return out if budget < 0 else out.where(F.col("visit_rank") <= budget)
