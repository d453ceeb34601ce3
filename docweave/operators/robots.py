"""Crawl rules from robots.txt bodies, and excluding pages by them.

Rules are computed inside each row with ``aggregate`` over the file's lines (a
small state machine, JVM-side, no shuffle).  Rule semantics:

* ``#`` starts a comment; lines are trimmed; a line emptied this way is blank.
* A ``User-agent:`` line always closes the current block; the value ``*`` or the
  crawler's own name (exact case) opens a new matching block and discards
  disallows collected so far.
* A blank line closes the block; after the crawler's own name was seen, a blank
  line ends the file.
* ``Disallow:`` inside a matching block adds its value (empty ones ignored, one
  trailing ``/`` cut, so ``Disallow: /`` becomes ``""`` = everything).
* ``Crawl-delay:`` inside a matching block sets the delay when it parses; the
  last one wins; default 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import jtrim
from .channels import small


def clean_lines(body: Column) -> Column:
    return F.transform(F.split(body, "\n"), lambda l: jtrim(F.regexp_replace(l, "#.*$", "")))


def robots_rules(body: Column, agent: str) -> Column:
    """``struct<disallows array<string>, crawl_delay_s bigint>`` for one file."""
    init = F.struct(F.lit(False).alias("in_hit"), F.lit(False).alias("own"),
                    F.lit(False).alias("stop"), F.array().cast("array<string>").alias("dis"),
                    F.lit(None).cast("bigint").alias("delay"))

    def step(s, line):
        low = F.lower(line)
        blank = line == ""
        is_ua = low.startswith("user-agent:")
        ua = jtrim(F.substring(line, 12, 1 << 30))
        hit = is_ua & ua.isin(agent, "*")
        is_dis = low.startswith("disallow:")
        dv = jtrim(F.substring(line, 10, 1 << 30))
        dv_cut = F.regexp_replace(dv, "/$", "")
        is_delay = low.startswith("crawl-delay:")
        dd = jtrim(F.substring(line, 13, 1 << 30)).try_cast("bigint")
        active = ~s["stop"]
        in_hit = (F.when(~active, s["in_hit"]).when(blank, False).when(is_ua, hit)
                  .otherwise(s["in_hit"]))
        own = s["own"] | (active & is_ua & (ua == agent))
        stop = s["stop"] | (blank & s["own"])
        dis = (F.when(~active, s["dis"]).when(hit, F.array().cast("array<string>"))
               .when(is_dis & s["in_hit"] & (dv != ""), F.concat(s["dis"], F.array(dv_cut)))
               .otherwise(s["dis"]))
        delay = F.when(active & is_delay & s["in_hit"] & dd.isNotNull(), dd).otherwise(s["delay"])
        return F.struct(in_hit.alias("in_hit"), own.alias("own"), stop.alias("stop"),
                        dis.alias("dis"), delay.alias("delay"))

    return F.aggregate(clean_lines(body), init, step,
                       lambda s: F.struct(s["dis"].alias("disallows"),
                                          F.coalesce(s["delay"], F.lit(0).cast("bigint"))
                                          .alias("crawl_delay_s")))


def parse_robots(robots_txt: DataFrame, agent: str) -> DataFrame:
    """F14 over ``robots_txt(host, body, fetched_at)`` -> ``robots(host,
    time_last_access, crawl_delay_s, disallows)``."""
    r = robots_txt.withColumn("_r", robots_rules(F.col("body"), agent))
    return r.select("host", F.col("fetched_at").alias("time_last_access"),
                    F.col("_r.crawl_delay_s").alias("crawl_delay_s"),
                    F.col("_r.disallows").alias("disallows"))


def allowed_pages(pages: DataFrame, robots: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """J2 + F13: pages whose path starts with no disallowed prefix of their host.

    A rule that a path starts with is one of the path's own prefixes, and its length is
    the length of some rule of the host.  So every (host, path) gives its prefixes of
    those lengths, and these meet the rules by equality: work grows with the pages times
    the distinct rule *lengths* of their host, not with its rules.  Rules and lengths are
    broadcast where they are measured to be small.
    """
    rules = robots.where(F.col("host").isNotNull()).select(
        F.col("host").alias("_h"), F.explode("disallows").alias("_rule")).where("_rule is not null").distinct()
    lengths = rules.select("_h", F.length("_rule").alias("_n")).distinct()
    keys = pages.select(F.col(host).alias("_h"), F.col(path).alias("_path")).distinct()
    prefixes = (keys.join(small(lengths), "_h").where(F.length("_path") >= F.col("_n"))
                .select("_h", "_path", F.substr("_path", F.lit(1), F.col("_n")).alias("_rule")))
    shut = prefixes.join(small(rules), ["_h", "_rule"], "left_semi").select("_h", "_path").distinct()
    return pages.join(shut, (pages[host] == shut["_h"]) & (pages[path] == shut["_path"]), "left_anti")
