"""Helpers that make order and ties explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_case(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule that holds; null conditions don't hold."""
    out = F.lit(otherwise)
    for condition, label in reversed(rules):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def has(text: str | Column, pattern: str) -> Column:
    """Case-insensitive search; a null text has nothing."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit("")).rlike(f"(?i){pattern}")


def once(value: Column, body) -> Column:
    """``body`` of a value that is named once, however often it is used there: the expression stays small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def nth_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order (give it a unique last item)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return nth_by(df, keys, order, 1)


def first_present(*columns: Column) -> Column:
    """The first column that is neither null nor an empty string."""
    return F.coalesce(*[F.when(F.length(c) > 0, c) for c in columns])
