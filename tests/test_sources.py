"""File sources, the bodies sink and charset decoding."""

import datetime as dt

from pyspark.sql import functions as F

from docweave.operators.render import decode_bodies
from docweave.sources import messages
from docweave.sources.documents import read_documents, read_xpaths, write_bodies


def test_document_source_rejects_other_kinds(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<a/>")
    (tmp_path / "b.html").write_text("<p>x")
    (tmp_path / "c.txt").write_text("nope")
    got = {(r.path.rsplit("/", 1)[-1], r.kind) for r in read_documents(spark, str(tmp_path)).collect()}
    assert got == {("a.xml", "xml"), ("b.html", "html")}


def test_xpath_file_source(spark, tmp_path):
    (tmp_path / "x.xp").write_text('/a/b\n/c[@d="1"] ; /e;;\n\n')
    got = [r.xpath for r in read_xpaths(spark, str(tmp_path / "x.xp")).collect()]
    assert got == ["/a/b", '/c[@d="1"]', "/e"]


def test_bodies_sink_partitions_by_host(spark, tmp_path):
    df = spark.createDataFrame([("http://a.com/x", "1"), ("http://b.com/y", "2")], "url string, body string")
    out = str(tmp_path / "bodies")
    write_bodies(df, out)
    back = spark.read.parquet(out)
    assert {(r.host, r.body) for r in back.collect()} == {("a.com", "1"), ("b.com", "2")}


def test_decode_bodies(spark):
    df = spark.createDataFrame([("é", "UTF-8"), ("é", "ISO-8859-1"), ("é", "x-unknown")],
                               "body string, encoding string")
    got = [r.n_chars for r in decode_bodies(df).collect()]
    assert got == [1, 2, 1]


def test_write_collections_sorted_per_channel(spark, tmp_path):
    from docweave.operators.render import write_collections
    frags = spark.createDataFrame([("c1", "http://b", "<document b/>"), ("c1", "http://a", "<document a/>"),
                                   ("c2", "http://z", "<document z/>")], "channel string, url string, fragment string")
    out = str(tmp_path / "coll")
    write_collections(frags, out, partitions=2)
    back = spark.read.text(out + "/channel=c1").collect()
    assert [r.value for r in back] == ["<documentcollection>", "<document a/>", "<document b/>",
                                       "</documentcollection>"]


def test_response_landing_folder(spark, tmp_path):
    from docweave.sources.documents import RESPONSE_SCHEMA, read_responses, stream_responses
    import datetime as dt
    out = str(tmp_path / "landing")
    rows = [(f"http://h/{i}", dt.datetime(2024, 1, 1), "HTTP/1.1 200 OK", "Content-Type: text/html", bytearray(b"<p>" + bytes([48 + i]))) for i in range(3)]
    spark.createDataFrame(rows, RESPONSE_SCHEMA).repartition(3).write.parquet(out)
    assert sorted(r.url for r in read_responses(spark, out).collect()) == [f"http://h/{i}" for i in range(3)]
    q = stream_responses(spark, out, 1).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")) \
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_library_works_from_any_folder(tmp_path):
    """Workers get the package with the first operator, without a registered query."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from docweave.session import local_session\nfrom docweave.operators import xpath_match as xm\n"
            "s = local_session(2)\n"
            "d = s.createDataFrame([('u', '<a/>')], 'doc_id string, body string')\n"
            "x = s.createDataFrame([('/a',)], 'xpath string')\n"
            "print('FOUND', xm.match_documents(d, x).collect())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "FOUND [Row(doc_id='u', xpath='/a')]" in done.stdout, done.stderr[-2000:]


# -- S1: raw messages

BOUNDARY = "\r\n--b0undary--\r\n"


def test_messages_round_trip_split_anywhere(spark, tmp_path):
    rows = [(f"http://h/{i}", dt.datetime(2024, 1, 1, 0, i % 60), "HTTP/1.1 200 OK", "A: b\nContent-Length: %d" % (n := i % 7 * 300),
             bytes((i * k) % 256 for k in range(n))) for i in range(60)]
    df = spark.createDataFrame(rows, messages.MESSAGE)
    messages.write_messages(df.coalesce(1), str(tmp_path / "m"), BOUNDARY)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        back = messages.read_messages(spark, str(tmp_path / "m"), BOUNDARY)
        assert back.rdd.getNumPartitions() > 20                  # most messages lie across parts
        assert sorted(tuple(r) for r in back.collect()) == sorted((u, t, s, h, bytearray(b)) for u, t, s, h, b in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    from docweave.streaming import jobs
    got = jobs.run_append(messages.stream_messages(spark, str(tmp_path / "m"), BOUNDARY), "messages")
    assert {r.url for r in got.collect()} == {r[0] for r in rows}


def test_bodies_as_the_headers_say(spark):
    parse = lambda head, body: messages.parse_message(b"http://h/ 2024-01-01T00:00:00\r\nHTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + body)[4]
    assert parse(b"Content-Length: 3", b"abcdef") == b"abc" and parse(b"content-length: -5", b"abcdef") == b"abcdef"
    assert parse(b"Content-Length: 99", b"ab") == b"ab" and parse(b"X: y", b"a\r\n\r\nb") == b"a\r\n\r\nb"
    chunks = b"4;x=y\r\nWiki\r\n6\r\npedia \r\nE\r\nin \r\n\r\nchunks.\r\n0\r\n\r\n"
    assert parse(b"Transfer-Encoding: Chunked\r\nContent-Length: 2", chunks) == b"Wikipedia in \r\n\r\nchunks."
    assert parse(b"Transfer-Encoding: chunked", chunks[:18]) == b"Wikipe"                        # cut short
    assert messages.parse_message(b"junk") == ("junk", None, None, "", b"")
    df = spark.createDataFrame([(b"",), (b"x" * 1234,), (b"\r\n0\r\n\r\n\xff",)], "body binary")
    back = df.select("body", messages.chunked_body(F.col("body"), 100).alias("sent")).collect()
    assert all(messages.unchunk(bytes(r.sent)) == bytes(r.body) for r in back)


# -- C12: charsets

def test_declared_charsets(spark):
    text = "Größe — žluťoučký"
    ru, jp = "Привет, мир", "日本語のページ"
    page = lambda t, name: f'<html><head><meta charset="{name}"></head><body>{t}'
    rows = [
        (page(ru, "koi8-r").encode("koi8-r"), "UTF-8", page(ru, "koi8-r"), "KOI8-R"),
        (page("Größe €", "windows-1252").encode("cp1252"), None, page("Größe €", "windows-1252"), "WINDOWS-1252"),
        (f"<?xml version='1.0' encoding='Shift_JIS'?><a>{jp}</a>".encode("shift_jis"), "KOI8-R", f"<?xml version='1.0' encoding='Shift_JIS'?><a>{jp}</a>", "SHIFT_JIS"),
        (b"\xef\xbb\xbf" + page(text, "koi8-r").encode(), "KOI8-R", page(text, "koi8-r"), "UTF-8"),                  # the mark wins
        (text.encode("utf-16"), None, text, "UTF-16LE"), (b"\xfe\xff" + text.encode("utf-16-be"), None, text, "UTF-16BE"),
        (text.encode("utf-32"), None, text, "UTF-32LE"),
        (b'<META HTTP-EQUIV="x" content="text/html; charset=iso-8859-2">' + "ž".encode("iso-8859-2"), None,
         '<META HTTP-EQUIV="x" content="text/html; charset=iso-8859-2">ž', "ISO-8859-2"),
        (ru.encode("cp1251"), "windows-1251", ru, "WINDOWS-1251"), (b"caf\xe9", "ISO-8859-1", "café", "ISO-8859-1"),
        (b"bad \xff byte", None, "bad � byte", "UTF-8"), ("é".encode(), "no-such-charset", "é", "NO-SUCH-CHARSET"), ("é".encode(), "rot13", "é", "ROT13"),
        (b"", None, "", "UTF-8"), (None, None, None, "UTF-8")]
    df = spark.createDataFrame([(i, b, h) for i, (b, h, _, _) in enumerate(rows)], "i int, body binary, encoding string")
    got = {r.i: (r.decoded, r.charset_used) for r in decode_bodies(df, detect=True).collect()}
    assert got == {i: (t, c) for i, (_, _, t, c) in enumerate(rows)}
