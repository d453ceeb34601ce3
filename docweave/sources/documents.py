"""Document and expression files, and the bodies sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import split_list, url_parts

# File suffix -> document kind; anything else is rejected.
KIND_BY_SUFFIX = {".xml": "xml", ".rss": "xml", ".html": "html", ".htm": "html"}


def read_documents(spark: SparkSession, path: str, recursive: bool = True, charset: str = "UTF-8") -> DataFrame:
    """``(path, kind, body)`` for every ``.xml/.rss/.html/.htm`` file under ``path``,
    decoded from ``charset``.

    ``binaryFile`` lists and reads files in parallel; the suffix filter runs on
    the listing, so rejected files are never read.
    """
    r = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
         .option("pathGlobFilter", "*.{xml,rss,html,htm}").load(path))
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    kind = F.create_map(*[x for k, v in KIND_BY_SUFFIX.items() for x in (F.lit(k), F.lit(v))])
    return (r.select("path", F.element_at(kind, suffix).alias("kind"),
                     F.decode("content", charset).alias("body"))
            .where(F.col("kind").isNotNull()))


#: What a fetcher lands: one row a response.
RESPONSE_SCHEMA = "url string, fetched_at timestamp, status_line string, header_block string, body binary"


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """A landing folder of response files (parquet), as a batch."""
    return spark.read.schema(RESPONSE_SCHEMA).parquet(path)


def stream_responses(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of responses."""
    r = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def documents_from_table(df: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """S2 over a table of (url, body): kind from the URL path suffix, anything
    but HTML/XML/RSS rejected (same rule as ``read_documents``)."""
    path = url_parts(F.col(url))["path"]
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    kind = F.create_map(*[x for k, v in KIND_BY_SUFFIX.items() for x in (F.lit(k), F.lit(v))])
    return (df.select(F.col(url).alias("url"), F.element_at(kind, suffix).alias("kind"),
                      F.col(body).alias("body"))
            .where(F.col("kind").isNotNull()))


def read_xpaths(spark: SparkSession, path: str) -> DataFrame:
    """S3: expression files, one expression per line or ``;``-separated."""
    lines = spark.read.text(path)
    return (lines.select(F.explode(split_list(F.col("value"))).alias("xpath"))
            .where(F.col("xpath") != ""))


def write_bodies(df: DataFrame, path: str, url: str = "url", body: str = "body") -> None:
    """Bodies written as parquet, partitioned by host (one folder per host).

    Rows are rebalanced by host: a small host is one file, and a host of any size is
    split into tasks of about the advisory partition size.
    """
    host = url_parts(F.col(url))["host"]
    (df.select(F.col(url).alias("url"), host.alias("host"), F.col(body).alias("body"))
     .hint("rebalance", "host").write.mode("overwrite").partitionBy("host").parquet(path))
