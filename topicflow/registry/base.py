"""Where queries and their SQL statements are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sql import statement
from .views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function of the views; ``sql`` states the same result over the named SQL views."""

    def add(build: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        if sql is not None:
            ORACLES[name] = statement(sql, *views.split())
        return build

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating point columns rounded, so that the order of a sum does not show."""
    kinds = dict(df.dtypes)
    return df.select([F.round(c, digits).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns])


def joined(column: str | Column, sep: str = " ") -> Column:
    return F.array_join(F.col(column) if isinstance(column, str) else column, sep)


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)
