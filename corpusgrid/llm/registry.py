"""Registration of the queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register ``fn(table)`` as a query over the whole of one table of a folder."""
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register
