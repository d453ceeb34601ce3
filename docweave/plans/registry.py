"""Query registry: name -> (Spark callable, SQL twin or None)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """What every query relies on: a checkpoint folder for lineage cuts, and the
    package in Python workers."""
    from ..session import ensure_checkpoint_dir, ship_package
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin over the input tables."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # times are UTC; expressions take the zone when the plan is made
            prepare(spark)
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return fn(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sql_str(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def values_sql(rows, cols: list[str]) -> str:
    """``(VALUES ...) AS t(cols)`` for a small parameter table."""
    body = ", ".join("(" + ", ".join(
        sql_str(v) if isinstance(v, str) or v is None else
        ("TRUE" if v is True else "FALSE" if v is False else str(v)) for v in r) + ")"
        for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"
