"""Engine tables derived from the input tables by Spark.

Every builder here has a SQL twin next to its queries computing the same rows
from the same parquet files, which is what makes the document queries
checkable against plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def _x(col) -> F.Column:
    """XML-escape a text column (``&`` first)."""
    c = F.col(col) if isinstance(col, str) else col
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def order_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, xml)``: one document per order (see ``order_xml_from``)."""
    return order_xml_from(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))


def order_xml_from(orders: DataFrame, lineitem: DataFrame, keep=()) -> DataFrame:
    """``(id, xml)``: one document per order.

    ``<g:order pri=P><status>S</status><date>yyyy-MM-dd</date>``
    ``(<line flag=R><st>L</st><pk>K</pk></line>)*</g:order>`` with lines in
    ``l_linenumber, l_returnflag, l_linestatus, l_partkey`` order (line numbers
    alone have ties).  An order's lines are one document, so the group is
    bounded by the document it builds; lines are pre-rendered before the
    shuffle so only short strings move.
    """
    li = lineitem.select(
        "l_orderkey",
        F.struct("l_linenumber", "l_returnflag", "l_linestatus", "l_partkey",
                 F.concat(F.lit('<line flag="'), _x("l_returnflag"), F.lit('"><st>'),
                          _x("l_linestatus"), F.lit("</st><pk>"),
                          F.col("l_partkey").cast("string"), F.lit("</pk></line>"))
                 .alias("x")).alias("ln"))
    lines = (li.groupBy("l_orderkey")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("ln")),
                                           lambda s: s["x"]), "").alias("lines")))
    o = orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate", *keep)
    # never broadcast by an estimate: collected lists are larger than Spark guesses
    return (o.join(lines.hint("merge"), o.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("id"),
                    F.concat(F.lit('<g:order pri="'), _x("o_orderpriority"),
                             F.lit('"><status>'), _x("o_orderstatus"),
                             F.lit("</status><date>"),
                             F.date_format("o_orderdate", "yyyy-MM-dd"),
                             F.lit("</date>"), F.coalesce("lines", F.lit("")),
                             F.lit("</g:order>")).alias("xml"), *keep))


# --- S1: responses synthesised from pages -------------------------------------
# Fixed values of the synthetic response generator (status, type, length and
# date variants are chosen by page_id arithmetic so SQL can restate them).
STATUS_BY_MOD20 = {0: "HTTP/1.1 404 Not Found", 1: "HTTP/1.1 301 Moved Permanently",
                   2: "HTTP/1.0 307 Temporary Redirect", 3: "HTTP/1.1 302 Found",
                   4: "HTTP/1.1 500 Internal Server Error"}
STATUS_DEFAULT = "HTTP/1.1 200 OK"
CTYPE_BY_MOD9 = {0: "text/xml", 1: "application/rss+xml", 2: None, 3: "image/png",
                 4: "application/xml; charset=ISO-8859-1"}
CTYPE_DEFAULT = "text/html; charset=utf-8"
BASE_MODIFIED = "2024-01-01 00:00:00"
BASE_FETCHED = "2024-02-01 00:00:00"


def _case(key: F.Column, table: dict, default):
    out = None
    for k, v in table.items():
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(key == k, lit) if out is None else out.when(key == k, lit)
    return out.otherwise(F.lit(default))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, fetched_at, status_line, header_block, body)`` from ``pages``."""
    return responses_from(read_table(spark, sf_dir, "pages"))


def responses_from(p: DataFrame) -> DataFrame:
    """Synthetic responses for a (batch or streaming) ``pages`` DataFrame."""
    from ..functions.urls import url_parts
    n = F.col("page_id")
    host = url_parts(F.col("url"))["host"]
    modified = F.timestamp_add("HOUR", n, F.lit(BASE_MODIFIED).cast("timestamp"))
    asctime = F.concat(F.date_format(modified, "EEE MMM "), F.lpad(F.dayofmonth(modified).cast("string"), 2, " "),
                       F.date_format(modified, " HH:mm:ss yyyy"))
    lm = (F.when(n % 4 == 0, F.concat(F.date_format(modified, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
          .when(n % 4 == 1, F.concat(F.date_format(modified, "EEEE, dd-MMM-yy HH:mm:ss"), F.lit(" GMT")))
          .when(n % 4 == 2, asctime).otherwise(F.lit("yesterday")))
    status = _case(n % 20, STATUS_BY_MOD20, STATUS_DEFAULT)
    ctype = _case(n % 9, CTYPE_BY_MOD9, CTYPE_DEFAULT)
    clen = (F.when(n % 11 == 0, F.lit("-5")).when(n % 11 == 1, F.lit("abc"))
            .otherwise(F.octet_length("html").cast("string")))
    lines = F.concat_ws(
        "\n",
        F.lit("Server: synth/1.0"),
        F.when(ctype.isNotNull(), F.concat(F.lit("Content-Type: "), ctype)),
        F.concat(F.lit("Content-Length: "), clen),
        F.concat(F.lit("Last-Modified: "), lm),
        F.when((n % 20 >= 1) & (n % 20 <= 3),
               F.concat(F.lit("Location: http://"), host, F.lit("/moved/"), n.cast("string"),
                        F.lit(".html"))),
        F.when(n % 5 == 0, F.concat(F.lit("Set-Cookie: a="), n.cast("string"))),
        F.when(n % 5 == 0, F.lit("set-cookie: b=2")),
        F.when(n % 6 == 0, F.lit("X-Empty:")),
    )
    return p.select(
        "page_id", "url",
        F.timestamp_add("MINUTE", n, F.lit(BASE_FETCHED).cast("timestamp")).alias("fetched_at"),
        status.alias("status_line"), lines.alias("header_block"), F.col("html").alias("body"))


def rss_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, xml)``: one RSS feed per document of ``documents``.

    ``<rss><channel><title>source</title><item><title>first line</title>``
    ``<description>whole text</description></item></channel></rss>`` with text
    XML-escaped.  One feed per document keeps every feed bounded by its
    document (no per-source group).
    """
    return rss_xml_from(read_table(spark, sf_dir, "documents"))


def rss_xml_from(d: DataFrame) -> DataFrame:
    """Feeds of a (batch or streaming) ``documents`` DataFrame."""
    first = F.element_at(F.split(F.col("text"), "\n"), 1)
    return d.select(F.col("doc_id").alias("id"), F.concat(
        F.lit("<rss><channel><title>"), _x("source"), F.lit("</title><item><title>"), _x(first),
        F.lit("</title><description>"), _x("text"), F.lit("</description></item></channel></rss>"))
        .alias("xml"))
