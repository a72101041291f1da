"""Registry of the query set: a Spark callable and, where SQL can say it, a reference SQL text per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"query {key} is defined twice")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return register


def sql_query(key: str, spark_sql: str, oracle: str | None = None, tables: tuple[str, ...] = ()) -> None:
    """A query that is one SQL text; the reference text is the same unless given."""
    from lamina.plans.fixtures import views

    @query(key, oracle or spark_sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        views(spark, sf)
        return spark.sql(spark_sql)
