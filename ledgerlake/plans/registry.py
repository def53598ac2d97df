"""Named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register f(tables) under a name, with equivalent SQL where there is one."""

    def add(f):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def real(c: Column) -> Column:
    return c.cast("double")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def joined(c: str | Column) -> Column:
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string")), ",")
