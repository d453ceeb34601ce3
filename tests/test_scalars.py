"""Scalar fixtures (FIXTURES.md section 6)."""

from pyspark.sql import functions as F

from docweave.functions import dates, headers, urls
from docweave.operators import fetch, robots


def _one(spark, expr, *vals, schema="v string"):
    df = spark.createDataFrame([vals], schema)
    return df.select(expr.alias("r")).first().r


def test_http_dates(spark):
    df = spark.createDataFrame([("Sun, 06 Nov 1994 08:49:37 GMT",), ("Sunday, 06-Nov-94 08:49:37 GMT",),
                                ("Sun Nov  6 08:49:37 1994",), ("yesterday",)], "v string")
    got = [r.t for r in df.select(F.date_format(dates.parse_http_date(F.col("v")),
                                                "yyyy-MM-dd HH:mm:ss").alias("t")).collect()]
    assert got == ["1994-11-06 08:49:37"] * 3 + [None]


def test_http_date_format(spark):
    got = _one(spark, dates.format_http_date(F.col("v").cast("timestamp")), "1994-11-06 08:49:37")
    assert got == "Sun, 06 Nov 1994 08:49:37 GMT"


def test_header_map(spark):
    m = _one(spark, headers.headers_map(F.col("v")), "A: 1\nB:\na: 2\n\nC: after-blank")
    assert m == {"a": "1;2"}


def test_content_type_and_encoding(spark):
    df = spark.createDataFrame([("text/html; charset=utf-8", "/x"), ("application/rss+xml", "/x"),
                                (None, "/f.rss"), ("image/png", "/y.html"), ("text/xml", "/z")],
                               "ct string, path string")
    got = [tuple(r) for r in df.select(fetch.content_type(F.col("ct"), F.col("path")),
                                       fetch.encoding(F.col("ct"))).collect()]
    assert got == [("html", "utf-8"), ("rss", "UTF-8"), ("rss", "UTF-8"), ("other", "UTF-8"),
                   ("xml", "UTF-8")]


def test_file_size(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("-5",), ("abc",), (None,)], "v string")
    assert [r[0] for r in df.select(fetch.file_size(F.col("v"))).collect()] == [12, 7, 0, 0, 0]


AGENT = "docweave"
ROBOTS = [
    ("User-agent: *\nDisallow: /a/\n\nDisallow: /b", ["/a"], 0),
    ("User-agent: *\nDisallow: /", [""], 0),
    ("User-agent: *\n# note\nDisallow: /a", [], 0),
    ("User-agent: *\nDisallow: /x\n\nUser-agent: docweave\nDisallow: /own/\nCrawl-delay: 4\n\n"
     "User-agent: *\nDisallow: /late", ["/own"], 4),
    ("User-agent: other\nDisallow: /o\nCrawl-delay: 9", [], 0),
]


def test_robots_rules(spark):
    df = spark.createDataFrame([(b,) for b, _, _ in ROBOTS], "body string")
    got = [(r.r.disallows, r.r.crawl_delay_s)
           for r in df.select(robots.robots_rules(F.col("body"), AGENT).alias("r")).collect()]
    assert got == [(d, c) for _, d, c in ROBOTS]


def test_allowed_pages(spark):
    rules = spark.createDataFrame([("h", ["/a", ""]), ("g", ["/b"])], "host string, disallows array<string>")
    pages = spark.createDataFrame([("h", "/a/1"), ("g", "/b"), ("g", "/c"), ("k", "/b")],
                                  "host string, path string")
    got = {tuple(r) for r in robots.allowed_pages(pages, rules).collect()}
    assert got == {("g", "/c"), ("k", "/b")}


def test_links_and_resolution(spark):
    html = ('<a HREF="/a.html">x</a>\n<a href=\'b/c\'> <a href="has space"> <a href="">'
            '<a href="http://o.org/x.rss"><a href="q;">')
    df = spark.createDataFrame([("http://ex.com/dir/p.html", html)], "url string, body string")
    lk = fetch.resolve_links(fetch.extract_links(df, "url", "body"))
    got = [(r.pos, r.dst, r.resolved, r.admissible) for r in lk.orderBy("pos").collect()]
    assert got == [(0, "/a.html", "http://ex.com/a.html", True),
                   (1, "b/c", "http://ex.com/dir/b/c", True),
                   (2, "http://o.org/x.rss", "http://o.org/x.rss", True),
                   (3, "q;", "http://ex.com/dir/q;", False)]
    concat = _one(spark, urls.resolve_link(F.col("v"), F.lit("x.html"), "concat"), "http://ex.com:81/d/p")
    assert concat == "http://ex.com:81/d/px.html"


def test_keys_and_params(spark):
    df = spark.createDataFrame([("HTTP://Ex.com/a/b?page=2&ref=x#top",), ("http://ex.com",)], "v string")
    got = [tuple(r) for r in df.select(urls.page_key(F.col("v")), urls.visit_key(F.col("v")),
                                       urls.query_param(F.col("v"), "ref")).collect()]
    assert got == [("ex.com/a/b", "ex.coma/b", "x"), ("ex.com", "ex.com", None)]


def test_dot_segments(spark):
    cases = {"../c": "http://h/a/c", "./c": "http://h/a/b/c", "../../../c?x=../y#..": "http://h/c?x=../y#..", "/x/./y/../z/": "http://h/x/z/",
             "..": "http://h/a/", ".": "http://h/a/b/", "c.d/..e": "http://h/a/b/c.d/..e"}
    df = spark.createDataFrame([(k,) for k in cases], "link string")
    got = {r.link: r.u for r in df.select("link", urls.resolve_link(F.lit("http://h/a/b/p.html"), F.col("link")).alias("u")).collect()}
    assert got == cases


def test_user_information_and_origin_mode(spark):
    df = spark.createDataFrame([("http://user:pw@Host.example:81/a?b@c",), ("http://h/@x",)], "v string")
    assert [(r.host, r.port, r.path) for r in df.select(urls.url_struct(F.col("v")).alias("u")).select("u.*").collect()] == [
        ("host.example", 81, "/a"), ("h", None, "/@x")]
    assert _one(spark, urls.resolve_link(F.col("v"), F.lit("x.html"), "origin"), "http://ex.com:81/d/p") == "http://ex.com/x.html"


def test_bytes_are_decoded_in_their_charset(spark):
    from docweave.operators import render
    df = spark.createDataFrame([(bytearray("é".encode("latin-1")), "ISO-8859-1"), (bytearray("é".encode()), None)], "body binary, encoding string")
    assert [r.decoded for r in render.decode_bodies(df).collect()] == ["é", "é"]


def test_rows_without_a_key_are_set_aside(spark):
    from docweave.operators import recrawl
    old = spark.createDataFrame([("a", 1, 0)], "page_key string, t int, v int")
    new = spark.createDataFrame([(None, 2, 1), (None, 2, 2), ("a", 2, 3)], "page_key string, t int, v int")
    assert [tuple(r) for r in recrawl.latest_wins(old, new, "page_key", ["t"]).collect()] == [("a", 2, 3)]
    assert recrawl.without_key(new).count() == 2
