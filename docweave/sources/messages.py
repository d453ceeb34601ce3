"""Raw HTTP responses in large files of many messages, as a batch or a stream.

A message is a line ``url fetched_at`` and the response as it came: status line, header
lines, an empty line, the body.  Messages are parted by a boundary that no message
holds (as in MIME; a folder has its own).  Spark's reader finds the boundaries, so a
file of any size is split between tasks wherever it falls, a message belongs to the
task in whose part it begins, and a stream keeps the files it has read as its offsets.

The body is what the headers say: the chunks of a chunked body put together, the first
``Content-Length`` bytes, or all there is.  A message cut short gives what is there; one
without a head of two lines has a null status line.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "url string, fetched_at timestamp, status_line string, header_block string, body binary"


def unchunk(raw: bytes) -> bytes:
    """The body of chunked transfer coding; ends at the last chunk or where it breaks."""
    out, at = [], 0
    while True:
        end = raw.find(b"\r\n", at)
        if end < 0:
            break
        try:
            size = int(raw[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            break
        if size <= 0:
            break
        out.append(raw[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def parse_message(raw: bytes) -> tuple[str | None, str | None, str | None, str, bytes]:
    """(url, fetched_at, status line, header block, body) of one message."""
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    url, _, fetched = lines[0].partition(" ")
    headers = lines[2:]
    known = {}
    for line in headers:
        name, colon, value = line.partition(":")
        if colon:
            known[name.strip().lower()] = value.strip()
    length = known.get("content-length", "")
    if known.get("transfer-encoding", "").lower() == "chunked":
        body = unchunk(body)
    elif length.isascii() and length.isdigit():
        body = body[:int(length)]
    return url or None, fetched or None, lines[1] if len(lines) > 1 else None, "\n".join(headers), body


def _parse(batches):
    names = ["url", "fetched", "status_line", "header_block", "body"]
    for batch in batches:
        rows = [parse_message(m.as_py()) for m in batch.column(0)]
        cols = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names)


def _messages(lines: DataFrame) -> DataFrame:
    from ..session import ship_package
    ship_package(lines.sparkSession)
    raw = lines.select(F.col("value").cast("binary").alias("raw")).where(F.octet_length("raw") > 0)
    parsed = raw.mapInArrow(_parse, "url string, fetched string, status_line string, header_block string, body binary")
    return parsed.select("url", F.try_to_timestamp("fetched", F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("fetched_at"), "status_line", "header_block", "body")


def read_messages(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """A folder of message files as a batch of responses."""
    return _messages(spark.read.option("lineSep", boundary).text(path))


def stream_messages(spark: SparkSession, path: str, boundary: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The folder as a stream of responses."""
    r = spark.readStream.option("lineSep", boundary)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _messages(r.text(path))


def chunked_body(body: Column, size: int) -> Column:
    """A binary column in chunked transfer coding, in chunks of ``size`` bytes."""
    n = F.octet_length(body)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    piece = lambda a: F.substr(body, a + 1, F.lit(size))
    text = lambda c: c.cast("binary")
    parts = F.transform(starts, lambda a: F.concat(text(F.hex(F.octet_length(piece(a)).cast("long"))), text(F.lit("\r\n")), piece(a), text(F.lit("\r\n"))))
    return F.concat(F.aggregate(parts, F.lit("").cast("binary"), lambda x, y: F.concat(x, y)), text(F.lit("0\r\n\r\n")))


def write_messages(responses: DataFrame, path: str, boundary: str) -> None:
    """Write ``responses(url, fetched_at, status_line, header_block, body)`` as messages;
    ``body`` as it is sent.  No message may hold the boundary."""
    body = F.coalesce(F.col("body").cast("binary"), F.lit("").cast("binary"))
    head = F.concat_ws("\r\n", F.concat_ws(" ", "url", F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss")), "status_line",
                       F.when(F.length("header_block") > 0, F.replace("header_block", F.lit("\n"), F.lit("\r\n"))))
    raw = F.concat(head.cast("binary"), F.lit("\r\n\r\n").cast("binary"), body)
    responses.select(raw.cast("string").alias("value")).write.mode("overwrite").option("lineSep", boundary).text(path)
