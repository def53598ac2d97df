"""Partitions and keys told by paths: cadence and period folders, dated keys and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = r"/(monthly|fortnightly)/(20\d{2}-\d{2}(?:-\d{2})?)(?:/|$)"


def cadence_of(path: Column) -> Column:
    """The cadence folder of a path, or null."""
    return F.nullif(F.regexp_extract(F.lower(path), PERIOD, 1), F.lit(""))


def period_of(path: Column) -> Column:
    """The period folder of a path, or null."""
    return F.nullif(F.regexp_extract(F.lower(path), PERIOD, 2), F.lit(""))


def with_partitions(files: DataFrame, path: str = "path") -> DataFrame:
    return files.withColumn("cadence", cadence_of(F.col(path))).withColumn("period", period_of(F.col(path)))


def periods(files: DataFrame, cadence: str, path: str = "path") -> DataFrame:
    """The period folders under a cadence, each once, in order."""
    return with_partitions(files, path).where(F.col("cadence") == cadence).select("period").where("period is not null").distinct().orderBy("period")


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of the files below a folder, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def dimension(spark: SparkSession, path: str, entries: str) -> DataFrame:
    """The entries of a small JSON document (a registry, a map of codes, locks), one row each."""
    return spark.read.option("multiLine", "true").json(path).select(F.explode(entries).alias("x")).select("x.*")


def asof_key(as_of: Column, portfolio_id: Column) -> Column:
    """Where a dated book is stored."""
    return F.concat(F.lit("portfolios/asof/"), as_of.cast("string"), F.lit("/"), F.regexp_replace(portfolio_id, r"[^A-Za-z0-9._-]", "_"), F.lit(".json"))


def api_link(code: Column, as_of: Column) -> Column:
    """The link that serves a code's book of a date (null: the newest)."""
    return F.concat(F.lit("/api/amfi/"), code, F.coalesce(F.concat(F.lit("?as_of="), as_of.cast("string")), F.lit("")))
