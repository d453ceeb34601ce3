"""Response-level filters and projections.

All row-local expressions: no shuffle.  Keep ``body`` a separate column and
apply these filters *before* parsing documents, so Catalyst prunes the body
column for rows that never reach the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.headers import header, headers_map, jtrim
from ..functions.urls import (href_links, link_admissible, resolve_link, url_parts,
                              url_struct)

STATUS_RE = r"^HTTP/\S+\s+(\d{3})"


def status_code(status_line: Column) -> Column:
    return F.regexp_extract(status_line, STATUS_RE, 1)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns as one generated row: they are computed once a row, however often
    later steps read them (Spark copies neither them nor filters across it)."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def with_headers(resp: DataFrame, block: str = "header_block") -> DataFrame:
    """adds ``status`` (3-digit code, ``""`` if none) and ``headers`` map."""
    return _once(resp, status=status_code(F.col("status_line")), headers=headers_map(F.col(block)))


def status_ok(resp: DataFrame) -> DataFrame:
    """only ``200`` responses."""
    return resp.where(F.col("status") == "200")


def redirects(resp: DataFrame, codes=("301", "307")) -> DataFrame:
    """responses that redirect; ``redirect_to`` is the trimmed ``location``."""
    loc = header(F.col("headers"), "location")
    return (resp.where(F.col("status").isin(*codes) & loc.isNotNull())
            .withColumn("redirect_to", jtrim(loc)))


def content_type(ct: Column, path: Column) -> Column:
    """``xml`` / ``html`` / ``rss`` / ``other``."""
    main = F.split(ct, ";").getItem(0)
    by_header = (F.when(main.contains("text/xml") | main.contains("application/xml"), "xml")
                 .when(main.contains("text/html"), "html")
                 .when(path.endswith(".rss") | main.contains("application/rss+xml"), "rss")
                 .otherwise("other"))
    by_suffix = (F.when(path.endswith(".html"), "html").when(path.endswith(".xml"), "xml")
                 .when(path.endswith(".rss"), "rss").otherwise("other"))
    return (F.when(ct.isNull(), by_suffix)
            .when(F.coalesce(main, F.lit("")) == "", F.lit("other"))
            .otherwise(by_header))


def encoding(ct: Column, default: str = "UTF-8") -> Column:
    """charset named in the second ``;`` segment, else ``default``."""
    parts = F.split(F.regexp_replace(ct, ";+$", ""), ";")
    seg = jtrim(parts.getItem(1))
    return (F.when((F.size(parts) == 2) & (parts.getItem(1) != ""),
                   F.regexp_replace(seg, "^(?i)charset=", ""))
            .otherwise(F.lit(default)))


def file_size(cl: Column) -> Column:
    """content length when it parses as a non-negative integer, else 0."""
    v = jtrim(cl).try_cast("bigint")
    return F.when(v >= 0, v).otherwise(F.lit(0).cast("bigint"))


def classify(resp: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``type``, ``encoding``, ``file_size`` from the header map."""
    ct = header(F.col("headers"), "content-type")
    path = url_parts(F.col(url))["path"]
    return _once(resp, type=content_type(ct, path), encoding=encoding(ct),
                 file_size=file_size(header(F.col("headers"), "content-length")))


def fetchable(resp: DataFrame, max_bytes: int) -> DataFrame:
    """F8: drop ``other`` types and files larger than ``max_bytes``."""
    return resp.where((F.col("type") != "other") & (F.col("file_size") <= max_bytes))


def extract_links(df: DataFrame, src: str = "url", body: str = "body",
                  type_col: str | None = None) -> DataFrame:
    """``(src, pos, dst)``; with ``type_col`` only ``html`` rows yield links."""
    links = href_links(F.col(body))
    if type_col is not None:
        links = F.when(F.col(type_col) == "html", links)
    return df.select(F.col(src).alias("src"), F.posexplode(links).alias("pos", "dst"))


def due_pages(pages: DataFrame, now: Column, last_access: str = "time_last_access",
              delay_s: str = "crawl_delay_s") -> tuple[DataFrame, DataFrame]:
    """(due, deferred) split: deferred when ``now - last_access < delay``."""
    wait = (F.unix_micros(now) - F.unix_micros(F.col(last_access))) < F.col(delay_s) * 1_000_000
    deferred = F.coalesce(wait, F.lit(False))
    return pages.where(~deferred), pages.where(deferred)


def resolve_links(links: DataFrame, schemes=("http",), with_concat: bool = False) -> DataFrame:
    """C2 + F12 over a link table: adds ``resolved`` and ``admissible``.

    URL parts are computed once per row as struct columns so the regular
    expressions are not repeated inside every derived expression.
    """
    df = links.withColumn("_b", url_struct(F.col("src")))
    df = df.withColumn("resolved", resolve_link(F.col("src"), F.col("dst"), base_parts=F.col("_b")))
    if with_concat:
        df = df.withColumn("resolved_concat", resolve_link(
            F.col("src"), F.col("dst"), "concat", base_parts=F.col("_b")))
    df = df.withColumn("_r", url_struct(F.col("resolved")))
    df = df.withColumn("admissible", F.coalesce(link_admissible(
        F.col("dst"), F.col("resolved"), schemes, resolved_parts=F.col("_r")), F.lit(False)))
    return df.drop("_b", "_r")


def kept_links(df: DataFrame, src: str = "url", body: str = "body", type_col: str | None = None,
               schemes=("http",)) -> DataFrame:
    """C1 + F20 + C2 + F12 in one pass per page: ``(src, pos, dst, resolved)``
    for the links a crawler follows.

    Links are resolved and tested inside the page's link array (the page URL is
    parsed once per page), and only kept links are exploded, so no filter has
    to repeat the resolution per row.
    """
    links = href_links(F.col(body))
    if type_col is not None:
        links = F.when(F.col(type_col) == "html", links)
    page = df.select(F.col(src).alias("src"), links.alias("_l")).withColumn(
        "_b", url_struct(F.col("src")))

    def one(link, i):
        res = resolve_link(F.col("src"), link, base_parts=F.col("_b"))
        return F.struct(i.alias("pos"), link.alias("dst"), res.alias("resolved"))

    items = F.transform(F.col("_l"), one)
    keep = F.filter(items, lambda x: F.coalesce(
        link_admissible(x["dst"], x["resolved"], schemes), F.lit(False)))
    return page.select("src", F.inline(keep))
