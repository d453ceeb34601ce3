"""Rendering channels, decoding bodies.

A channel's collection is emitted as one XML fragment per (channel, page)
row, not as one string per channel: a channel holding a third of all pages
would otherwise become one row in one task.  ``write_collections`` writes the
fragments range-partitioned and sorted by (channel, url), so each channel's
collection is its part files read in order, wrapped in
``<documentcollection>``.
"""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The collection wrapper.
COLLECTION_OPEN = "<documentcollection>"
COLLECTION_CLOSE = "</documentcollection>"


def drop_declarations(data: Column) -> Column:
    """remove lines that start (after leading blanks) with ``<?``."""
    lines = F.split(data, "\n")
    keep = F.filter(lines, lambda l: ~F.regexp_replace(l, r"^[\x00-\x20]+", "").startswith("<?"))
    return F.array_join(keep, "\n")


def channel_fragments(channel_pages: DataFrame, meta: DataFrame, data: DataFrame) -> DataFrame:
    """J8 + F19 + A8: ``(channel, url, fragment)`` for the XML pages of each channel."""
    from ..functions.urls import page_key
    cp = channel_pages.withColumn("page_key", page_key(F.col("url")))
    m = meta.where(F.col("type") == "xml").select("page_key", "time_last_access")
    d = data.select("page_key", "data")
    j = cp.join(m, "page_key").join(d, "page_key")
    frag = F.concat(F.lit('<document crawled="'),
                    F.date_format("time_last_access", "yyyy-MM-dd HH:mm:ss"),
                    F.lit('" location="'), F.col("url"), F.lit('">'),
                    drop_declarations(F.col("data")), F.lit("</document>"))
    return j.select("channel", "url", frag.alias("fragment"))


def collection_rows(fragments: DataFrame) -> DataFrame:
    """``channel, part, url, fragment``: each channel's collection row by row, in the
    order (part, url): an opening (part 0), the fragments (1), a closing (2)."""
    chans = fragments.select("channel").distinct()
    edge = lambda part, text: chans.select("channel", F.lit(part).alias("part"), F.lit(None).cast("string").alias("url"),
                                           F.lit(text).alias("fragment"))
    inner = fragments.select("channel", F.lit(1).alias("part"), "url", "fragment")
    return inner.unionByName(edge(0, COLLECTION_OPEN)).unionByName(edge(2, COLLECTION_CLOSE))


def write_collections(fragments: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write each channel's collection as text, one folder per channel.

    Rows are range-partitioned and sorted by (channel, part, url), so a channel's
    part files read in order form one ``<documentcollection>``
    and a large channel spreads over several ranges instead of one task.
    """
    n = partitions or fragments.sparkSession.sparkContext.defaultParallelism
    order = ["channel", "part", "url"]
    (collection_rows(fragments).repartitionByRange(n, *order).sortWithinPartitions(*order)
     .select("channel", "fragment").write.mode("overwrite").partitionBy("channel").text(path))


#: Byte-order marks in hex and their charsets; longer ones first.
BYTE_ORDER_MARKS = [("FFFE0000", "UTF-32LE"), ("0000FEFF", "UTF-32BE"), ("EFBBBF", "UTF-8"), ("FFFE", "UTF-16LE"), ("FEFF", "UTF-16BE")]
#: Bytes at the start of a page in which it may declare its charset (as browsers read it).
DECLARED_IN = 1024


def _bytes(df: DataFrame, body: str) -> Column:
    return F.col(body) if df.schema[body].dataType.simpleString() == "binary" else F.col(body).cast("binary")


def declared_charset(raw: Column, header: Column) -> Column:
    """The charset of a page: its byte-order mark, else what its XML declaration, its
    ``<meta>`` element or the response header names, in this order; else UTF-8."""
    start = F.decode(F.substr(raw, F.lit(1), F.lit(DECLARED_IN)), "ISO-8859-1")
    mark = F.hex(F.substr(raw, F.lit(1), F.lit(4)))
    by_mark = None
    for bytes_, name in BYTE_ORDER_MARKS:
        by_mark = F.when(mark.startswith(bytes_), name) if by_mark is None else by_mark.when(mark.startswith(bytes_), name)
    xml = F.regexp_extract(start, r"""^\s*<\?xml[^>]*\sencoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""", 1)
    meta = F.regexp_extract(start, r"""(?i)<meta[^>]*\scharset\s*=\s*["']?\s*([A-Za-z0-9._:-]+)""", 1)
    inside = F.regexp_extract(start, r"""(?i)<meta[^>]*\scontent\s*=\s*["'][^"'>]*charset\s*=\s*([A-Za-z0-9._:-]+)""", 1)
    named = [F.nullif(c, F.lit("")) for c in (xml, meta, inside, F.trim(header))]
    return F.upper(F.coalesce(by_mark, *named, F.lit("UTF-8")))


@F.pandas_udf(T.StringType())
def _decode_other(raw: pd.Series, charset: pd.Series) -> pd.Series:
    """Any charset that Python knows, bad bytes replaced; an unknown name counts as UTF-8."""
    def one(b, name):
        if b is None:
            return None
        try:
            codecs.lookup(name)
        except (LookupError, TypeError):
            name = "utf-8"
        try:
            return bytes(b).decode(name, "replace").encode("utf-8", "replace").decode("utf-8")
        except (LookupError, UnicodeError):               # a codec that is no charset
            return bytes(b).decode("utf-8", "replace")
    return pd.Series([one(b, c) for b, c in zip(raw, charset)], dtype=object)


def decode_bodies(df: DataFrame, body: str = "body", charset: str = "encoding", detect: bool = False) -> DataFrame:
    """``decoded`` and ``n_chars``: body bytes (a string body: its UTF-8 bytes) in the
    charset that column ``charset`` names or, with ``detect``, that ``declared_charset``
    finds (column ``charset_used``).  UTF-8 and ISO-8859-1 are decoded by Spark, any other
    by an Arrow function that gets only those rows.  Bad bytes become U+FFFD; a
    byte-order mark is no part of the text."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    raw = _bytes(df, body)
    name = declared_charset(raw, F.col(charset)) if detect else F.upper(F.coalesce(F.col(charset), F.lit("UTF-8")))
    named = df.withColumn("charset_used", name)
    native = F.col("charset_used").isin("UTF-8", "ISO-8859-1")
    other = named.withColumn("_other", _decode_other(F.when(~native, raw), F.when(~native, F.col("charset_used"))))
    decoded = (F.when(F.col("charset_used") == "UTF-8", F.make_valid_utf8(raw.cast("string")))
               .when(F.col("charset_used") == "ISO-8859-1", F.decode(raw, "ISO-8859-1")).otherwise(F.col("_other")))
    text = F.when(decoded.startswith("\ufeff"), F.substr(decoded, F.lit(2))).otherwise(decoded)
    return other.withColumn("decoded", text).drop("_other").withColumn("n_chars", F.length("decoded").cast("long"))
