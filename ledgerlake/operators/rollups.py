"""Rollups that are kept by period and added up: a late period is counted again alone, never the whole history.

A state is one row a key and period: rows, first and last day, days with rows, and a sketch of the distinct codes
(HyperLogLog, ``PRECISION`` bits: a relative standard error of about 1.04 / sqrt(2^PRECISION), 1.6 % at 12).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def states(rows: DataFrame, keys: list[str], period: Column, day: str, code: str) -> DataFrame:
    """The state of every key and period; null codes don't count, null days aren't first or last."""
    by = rows.groupBy(*keys, period.alias("period"))
    return by.agg(F.count("*").alias("n"), F.min(day).alias("first"), F.max(day).alias("last"), F.count_distinct(day).alias("days"), F.hll_sketch_agg(F.col(code), PRECISION).alias("codes"))


def refreshed(held: DataFrame, again: DataFrame) -> DataFrame:
    """Held states with those of some periods counted again: a period in ``again`` is replaced for all keys."""
    done = again.select("period").distinct()
    return held.join(done, "period", "left_anti").unionByName(again)


def merged(held: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key over all its periods: rows, first and last day, days, the estimated number of distinct codes."""
    by = held.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("days").alias("days"), F.hll_union_agg("codes").alias("codes"))
    return by.withColumn("codes", F.hll_sketch_estimate("codes"))


def most_common(rows: DataFrame, value: str, most: int = 20) -> DataFrame:
    """The most common values with their counts (a report's length); ties: the least value."""
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), value).limit(most)
