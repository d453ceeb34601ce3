"""Readers for the input tables, always with an explicit schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, S, D, I, TS = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TABLE_SCHEMAS: dict[str, T.StructType] = {
    "pages": _st(("page_id", L), ("url", S), ("html", S)),
    "documents": _st(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                  ("value", D), ("props", S)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                  ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one input table; known tables get their schema."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
