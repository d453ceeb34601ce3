"""URLs and links as column expressions.

URL parts come from one anchored regular expression rather than a URL parser,
so malformed input yields nulls instead of failing a task, and the same
pattern runs in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme://[user[:password]@]host[:port]path[?query][#fragment]
URL_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/:?#]*)(:([0-9]+))?([^?#]*)(\?([^#]*))?(#(.*))?$"
SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
# href= followed by a quoted value without blanks or line breaks (per line, case-blind)
HREF_RE = r"""[Hh][Rr][Ee][Ff][ \t]*=[ \t]*("[^" \n\r]*"|'[^' \n\r]*')"""
# Link suffixes a crawler follows ("" = no suffix).
FOLLOW_SUFFIXES = ("", ".html", ".xml", ".rss")


def url_struct(url: Column) -> Column:
    """C4 as one struct column; add it with ``withColumn`` before using its
    fields several times, so the regular expressions run once per row."""
    return F.struct(*[v.alias(k) for k, v in url_parts(url).items()])


def url_parts(url: Column) -> dict[str, Column]:
    """C4: scheme, host, port (null when absent), path, query, fragment; user
    information before the host is no part of them."""
    # the scheme group is mandatory, so an empty scheme means "no match"
    ok = F.regexp_extract(url, URL_RE, 1) != ""

    def g(i):
        return F.when(ok, F.regexp_extract(url, URL_RE, i))
    port = g(4)
    query_ = g(7)
    frag = g(9)
    has_q = F.when(ok, F.regexp_extract(url, URL_RE, 6) != "")
    has_f = F.when(ok, F.regexp_extract(url, URL_RE, 8) != "")
    return {
        "scheme": F.lower(g(1)),
        "host": F.lower(g(2)),
        "port": F.when(port != "", port.cast("int")),
        "path": g(5),
        "query": F.when(has_q, query_),
        "fragment": F.when(has_f, frag),
    }


def path_suffix(path: Column) -> Column:
    """From the last ``.`` of the path to its end, ``""`` when there is none."""
    return F.trim(F.regexp_extract(path, r"\.[^.]*$", 0))


def page_key(url: Column) -> Column:
    """``host ++ path`` (scheme, port, query and fragment dropped)."""
    p = url_parts(url)
    return F.concat(p["host"], p["path"])


def visit_key(url: Column) -> Column:
    """``host ++ path`` without one leading ``/`` (so ``""`` and ``/`` agree)."""
    p = url_parts(url)
    return F.concat(p["host"], F.regexp_replace(p["path"], r"^/", ""))


def href_links(html: Column) -> Column:
    """``array<string>`` of quoted ``href`` values in document order (empty ones dropped)."""
    raw = F.regexp_extract_all(html, F.lit(HREF_RE), 1)
    return F.filter(F.transform(raw, lambda s: F.regexp_replace(s, r"^.|.$", "")),
                    lambda s: s != "")


def without_dot_segments(path: Column) -> Column:
    """A path that starts with ``/`` without its ``.`` and ``..`` segments (RFC 3986)."""
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, s: (
        F.when(s == ".", done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, s))))
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(F.concat(kept, tail), "/"))).otherwise(path)


def resolve_link(base: Column, link: Column, mode: str = "rfc3986",
                 base_parts: Column | None = None) -> Column:
    """Absolute form of ``link`` found on page ``base``.

    ``mode="concat"`` reproduces plain concatenation: a link without a scheme
    is appended to ``scheme://host[:port]`` + the page path (``/`` if empty).
    ``mode="origin"`` puts it behind ``scheme://host`` instead, as link expansion
    does (C3).  ``mode="rfc3986"`` resolves scheme-relative, root-relative,
    query-only, fragment-only and directory-relative references and removes dot
    segments.
    """
    p = url_parts(base) if base_parts is None else {
        k: base_parts[k] for k in ("scheme", "host", "port", "path", "query", "fragment")}
    origin = F.concat(p["scheme"], F.lit("://"), p["host"],
                      F.when(p["port"].isNotNull(), F.concat(F.lit(":"), p["port"].cast("string")))
                      .otherwise(F.lit("")))
    path = F.when(p["path"] == "", F.lit("/")).otherwise(p["path"])
    absolute = link.rlike(SCHEME_RE)
    if mode == "concat":
        rel = F.trim(F.concat(origin, path, link))
    elif mode == "origin":
        rel = F.concat(p["scheme"], F.lit("://"), p["host"], F.when(link.startswith("/"), F.lit("")).otherwise(F.lit("/")), link)
    elif mode == "rfc3986":
        directory = F.regexp_extract(path, r"^(.*/)", 1)
        query_ = F.when(p["query"].isNotNull(), F.concat(F.lit("?"), p["query"])).otherwise(F.lit(""))
        link_path = F.regexp_extract(link, r"^[^?#]*", 0)
        link_rest = F.regexp_extract(link, r"(?s)[?#].*$", 0)
        rel = (F.when(link.startswith("//"), F.concat(p["scheme"], F.lit(":"), link))
               .when(link.startswith("/"), F.concat(origin, without_dot_segments(link_path), link_rest))
               .when(link.startswith("?"), F.concat(origin, path, link))
               .when(link.startswith("#"), F.concat(origin, path, query_, link))
               .when(link == "", F.concat(origin, path, query_))
               .otherwise(F.concat(origin, without_dot_segments(F.concat(directory, link_path)), link_rest)))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(p["scheme"].isNull() & ~absolute, F.lit(None)).when(absolute, link).otherwise(rel)


def link_admissible(link: Column, resolved: Column, schemes=("http",),
                    resolved_parts: Column | None = None) -> Column:
    """not ending ``;``, scheme allowed, path suffix in ``FOLLOW_SUFFIXES``."""
    p = url_parts(resolved) if resolved_parts is None else resolved_parts
    return (~link.endswith(";") & p["scheme"].isin(*schemes)
            & path_suffix(p["path"]).isin(*FOLLOW_SUFFIXES))


def split_list(c: Column, sep: str = ";") -> Column:
    """``a ; b;;c`` -> ``[a, b, c]`` (blanks around items and empty items dropped)."""
    return F.filter(F.transform(F.split(c, sep), lambda s: F.trim(s)), lambda s: s != "")


def query_param(url: Column, name: str) -> Column:
    """C11: value of one query-string parameter (up to the next ``&``), null when absent."""
    q = F.concat(F.lit("&"), url_parts(url)["query"])
    return F.when(q.contains(f"&{name}="), F.regexp_extract(q, r"&" + name + r"=([^&]*)", 1))


def url_decode(c: Column) -> Column:
    """percent/plus decoding; null when the text is not decodable."""
    return F.try_url_decode(c)
