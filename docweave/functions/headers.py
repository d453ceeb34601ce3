"""Response header block -> map, row-local (higher-order functions, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim(): strips every char <= U+0020 at both ends.
JTRIM_RE = r"^[\x00-\x20]+|[\x00-\x20]+$"
NAME_RE = r"([A-Za-z\-]*):"


def jtrim(c: Column) -> Column:
    return F.regexp_replace(c, JTRIM_RE, "")


def header_lines(block: Column) -> Column:
    """Lines of a header block up to (not including) the first empty line."""
    lines = F.split(block, r"\r?\n")
    stop = F.array_position(lines, F.lit(""))
    return F.when(stop > 0, F.slice(lines, 1, (stop - 1).cast("int"))).otherwise(lines)


def header_entries(block: Column) -> Column:
    """``array<struct<pos, key, value>>`` of the well-formed header lines.

    A line's name is the run of ``[A-Za-z-]`` just before its first ``:``,
    lower-cased; the value starts one character after the colon and is trimmed;
    a line with nothing after ``": "`` is skipped.
    """
    lines = header_lines(block)

    def entry(line, i):
        c = F.instr(line, ":")
        return F.struct(i.alias("pos"), (c > 0) & (c <= F.length(line) - 2),
                        F.lower(F.regexp_extract(line, NAME_RE, 1)).alias("key"),
                        jtrim(F.substring(line, c + 2, 1 << 30)).alias("value"))
    raw = F.transform(lines, entry)
    return F.transform(F.filter(raw, lambda e: e["col2"]),
                       lambda e: F.struct(e["pos"].alias("pos"), e["key"].alias("key"),
                                          e["value"].alias("value")))


def headers_map(block: Column) -> Column:
    """``map<string,string>``; repeated names joined with ``;`` in line order."""
    es = header_entries(block)
    keys = F.array_distinct(F.transform(es, lambda e: e["key"]))
    vals = F.transform(keys, lambda k: F.array_join(
        F.transform(F.filter(es, lambda e: e["key"] == k), lambda e: e["value"]), ";"))
    return F.map_from_arrays(keys, vals)


def header(hmap: Column, name: str) -> Column:
    return F.try_element_at(hmap, F.lit(name.lower()))
