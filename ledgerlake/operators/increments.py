"""Incremental runs: what is left to do, checkpoints, snapshots, and the order of jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..rules import ordered_case


def todo(files: DataFrame, outputs: DataFrame, key: str = "path") -> DataFrame:
    """Files without outputs, or with one older than themselves."""
    done = outputs.groupBy(key).agg(F.min("modified").alias("__done"))
    return files.join(done, key, "left").where(F.col("__done").isNull() | (F.col("__done") < F.col("modified"))).drop("__done")


def checkpoint_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A line-by-line JSON checkpoint; lines cut off by a crash are dropped."""
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path).where("_bad is null").drop("_bad")


def largest_snapshot(rows: DataFrame, file: str = "file") -> DataFrame:
    """The rows of the file with most rows (ties: the last name)."""
    best = rows.groupBy(file).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", file))[file].alias(file))
    return rows.join(F.broadcast(best), file, "left_semi")  # one row


def jobs(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Fetch jobs of each key's window of months (columns first, last: any days in them): mid-month, month-end fortnightly, month-end monthly, with their place in the order of time."""
    m = windows.select(*keys, F.explode(dates.months_between(F.col("first"), F.col("last"))).alias("m"))
    j = dates.in_sync_order(m, keys).drop("place")
    return j.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("as_of", "rank")))


def needs_rerun(months: DataFrame, today: str, month: str = "month") -> DataFrame:
    """The month before and the current one are done again; older ones are closed."""
    return months.where(F.col(month) >= F.add_months(F.trunc(F.lit(today).cast("date"), "MM"), -1))


def deltas(before: DataFrame, after: DataFrame, key: str, count: str) -> DataFrame:
    """Counts before and after a run with their difference."""
    j = before.select(key, F.col(count).alias("before")).join(after.select(key, F.col(count).alias("after")), key, "full_outer")
    j = j.na.fill(0, ["before", "after"]).withColumn("delta", F.col("after") - F.col("before"))
    return j.withColumn("change", ordered_case([(F.col("before") == 0, "new"), (F.col("after") == 0, "gone"), (F.col("delta") != 0, "changed")], "same"))


def month_groups(periods: DataFrame, period: str = "period") -> DataFrame:
    """Period folders by month, their order kept."""
    return periods.groupBy(F.substring(period, 1, 7).alias("ym")).agg(F.array_sort(F.collect_list(period)).alias("periods"))


def total_value(rows: DataFrame, keys: list[str], label: str, value: str, row_no: str) -> DataFrame:
    """The book's total among scored candidate rows: grand total, total net assets, net assets, totals; ties by size, then the earlier row."""
    t = F.lower(F.coalesce(F.col(label), F.lit("")))
    score = F.when(t.rlike(r"grand\s+total"), 20).when(t.rlike(r"total\s+net\s+assets?"), 18).when(t.rlike(r"net\s+assets?"), 12).when(t.rlike(r"^\s*total\s*:"), 10).otherwise(0) + F.when(F.col(value) > 0, 2).otherwise(0)
    w = Window.partitionBy(*keys).orderBy(F.col("__s").desc(), F.abs(F.col(value)).desc(), row_no)
    return rows.where(F.abs(F.col(value)) > 1.5).withColumn("__s", score).where("__s >= 10").withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*keys, F.col(value).alias("stated_total"))


def without_mega(files: DataFrame, group: str, path: str) -> DataFrame:
    """Workbooks without the consolidated ones, where a group has others."""
    mega = F.lower(F.col(path)).rlike(r"consolidated|all[\s_-]*schemes|mega")
    df = files.withColumn("__mega", mega).withColumn("__other", F.max(~mega).over(Window.partitionBy(group)))
    return df.where(~F.col("__mega") | ~F.col("__other")).drop("__mega", "__other")


def smallest_and_median(files: DataFrame, group: str, path: str, size: str) -> DataFrame:
    """Each group's smallest file and the one at place n // 2 by size."""
    w = Window.partitionBy(group)
    df = files.withColumn("__i", F.row_number().over(w.orderBy(size, path)) - 1).withColumn("__n", F.count("*").over(w))
    return df.where((F.col("__i") == 0) | (F.col("__i") == F.floor(F.col("__n") / 2))).drop("__i", "__n")
