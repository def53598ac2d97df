"""Checks before publication: each gives the violating rows; ``require_none`` turns them into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_none(violations: DataFrame, what: str, allowed: int = 0) -> None:
    n = violations.limit(allowed + 1).count()
    if n > allowed:
        raise ValueError(f"{what}: more than {allowed} violations")


def phantom_dates(advertised: DataFrame, books: DataFrame, keys: list[str]) -> DataFrame:
    """Advertised (id, date) pairs without a book."""
    return advertised.select(*keys).distinct().join(books.select(*keys).distinct(), keys, "left_anti")


def shrunken(before: DataFrame, after: DataFrame, key: str, count: str) -> DataFrame:
    """Keys whose count fell, or that went."""
    a, b = before.select(key, F.col(count).alias("before")), after.select(key, F.col(count).alias("after"))
    return a.join(b, key, "full_outer").withColumn("after", F.coalesce("after", F.lit(0))).where(F.col("after") < F.col("before"))


def uncovered(catalog: DataFrame, books: DataFrame, key: str) -> DataFrame:
    """Catalog rows whose newest date has no book."""
    return catalog.join(books, key, "left_anti")


def swapped_columns(plans: DataFrame, value: str = "nav", code: str = "isin") -> DataFrame:
    """Rows whose value looks like a code, or whose code looks like a value."""
    return plans.where(F.col(value).rlike(r"^[A-Z]{2}[A-Z0-9]{9}\d$") | F.col(code).rlike(r"^\d+(\.\d+)?$"))


def lock_mismatches(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """Locked bindings that are missing or differ, with the reason."""
    got = actual.select(key, F.col(value).alias("actual"), F.lit(True).alias("__seen"))
    out = expected.select(key, F.col(value).alias("expected")).join(got, key, "left")
    reason = F.when(F.col("__seen").isNull(), "missing").otherwise("differs")
    return out.where(~F.col("expected").eqNullSafe(F.col("actual"))).select(key, "expected", "actual", reason.alias("reason"))


def completeness(files: DataFrame, outputs: DataFrame, group: list[str], key: str) -> DataFrame:
    """Per group: files expected, covered, missing, and covered but older than their source."""
    done = outputs.groupBy(key).agg(F.min("modified").alias("__done"))
    x = files.join(done, key, "left")
    return x.groupBy(*group).agg(F.count("*").alias("expected"), F.count_if(F.col("__done") >= F.col("modified")).alias("covered"), F.count_if(F.col("__done").isNull()).alias("missing"), F.count_if(F.col("__done") < F.col("modified")).alias("stale"))


def severity(n: Column, warn: int = 0, fail: int = 20) -> Column:
    return F.when(n > fail, "fail").when(n > warn, "warn").otherwise("ok")


def stamped_runs(filings: DataFrame, share: float = 0.9, least: int = 20) -> DataFrame:
    """run_id, keys, stamped, phantom: runs whose keys nearly all bear the run's own day, as a sync does that stamps instead of reading.

    filings: run_id, run_day, key, as_of. A run of fewer than ``least`` keys isn't judged. A null date isn't stamped.
    """
    one = filings.groupBy("run_id", "key").agg(F.max(F.coalesce(F.col("as_of") == F.col("run_day"), F.lit(False)).cast("int")).alias("s"))
    runs = one.groupBy("run_id").agg(F.count("*").alias("keys"), F.sum("s").alias("stamped"))
    return runs.withColumn("phantom", (F.col("keys") >= least) & (F.col("stamped") >= share * F.col("keys")))


def without_stamps(filings: DataFrame, books: DataFrame, **params) -> DataFrame:
    """Filings without those that a phantom run stamped, unless their book (key, as_of) is there."""
    bad = stamped_runs(filings, **params).where("phantom").select("run_id", F.lit(True).alias("__bad"))
    have = books.select("key", "as_of", F.lit(True).alias("__book")).distinct()
    f = filings.join(bad, "run_id", "left").join(have, ["key", "as_of"], "left")
    stamped = F.col("__bad").isNotNull() & F.coalesce(F.col("as_of") == F.col("run_day"), F.lit(False))
    return f.where(~stamped | F.col("__book").isNotNull()).drop("__bad", "__book")
