"""The query registry."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrocar.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
