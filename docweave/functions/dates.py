"""HTTP dates.

Parsing tries, in order, RFC 1123 (``Sun, 06 Nov 1994 08:49:37 GMT``),
RFC 850 (``Sunday, 06-Nov-94 08:49:37 GMT``) and asctime
(``Sun Nov  6 08:49:37 1994``); the first that parses wins, otherwise null.
Spark cannot parse weekday names, so the leading weekday is stripped and
blanks are squeezed first.  A two-digit year that lands more than 20 years
after ``ref_year`` moves back a century (the usual two-digit-year window).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three accepted layouts after the weekday is removed.
RFC1123 = "dd MMM yyyy HH:mm:ss zzz"
RFC850 = "dd-MMM-yy HH:mm:ss zzz"
ASCTIME = "MMM d HH:mm:ss yyyy"


def parse_http_date(c: Column, ref_year: int = 2024) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.trim(c), r"^\s*[A-Za-z]+,?\s+", ""), r"\s+", " ")
    a = F.try_to_timestamp(s, F.lit(RFC1123))
    b = F.try_to_timestamp(s, F.lit(RFC850))
    b = F.when(F.year(b) > ref_year + 20, F.timestamp_add("YEAR", F.lit(-100), b)).otherwise(b)
    d = F.try_to_timestamp(s, F.lit(ASCTIME))
    return F.coalesce(a, b, d)


def format_http_date(ts: Column) -> Column:
    """``EEE, dd MMM yyyy HH:mm:ss GMT`` (session time zone must be UTC)."""
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def format_crawl_time(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
