"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of (t), t(name) being a table of the given folder."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = name
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register
