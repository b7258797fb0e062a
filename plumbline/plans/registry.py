"""Named queries over the driver's tables, each with the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function (t) -> DataFrame under its name; t(name) reads a table."""

    def wrap(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return wrap
