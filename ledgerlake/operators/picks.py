"""Dedup, precedence and top-k picks with explicit ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rules import first_by, nth_by


def keep_richest(df: DataFrame, key: str, count: str, ordinal: str, last_wins: bool) -> DataFrame:
    """The row with the largest count; ties by order, first or last. Null keys pass."""
    order = F.col(ordinal).desc() if last_wins else F.col(ordinal).asc()
    picked = first_by(df.where(F.col(key).isNotNull()), [key], [F.col(count).desc_nulls_last(), order])
    return picked.unionByName(df.where(F.col(key).isNull()))


def by_precedence(sources: list[DataFrame], keys: list[str], *ties: Column) -> DataFrame:
    """Union of sources of falling precedence; one row a key."""
    ranked = [s.withColumn("src_rank", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for s in ranked[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    return first_by(both, keys, [F.col("src_rank").asc(), *ties])


def resolve_first(rows: DataFrame, row_id: str, candidates: list[Column], lookup: DataFrame, key: str, value: str) -> DataFrame:
    """The value of the first candidate key that the lookup holds (null: none does)."""
    tried = rows.select("*", F.posexplode(F.array(*candidates)).alias("__prio", "__key"))
    look = lookup.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    hit = tried.join(look, "__key").groupBy(row_id).agg(F.min(F.struct("__prio", "__value")).alias("__hit"))
    return rows.join(hit, row_id, "left").withColumn("matched_by", F.col("__hit.__prio")).withColumn("resolved", F.col("__hit.__value")).drop("__hit")


def collapse_group(df: DataFrame, keys: list[str], code: str, preference: Column, **aggregates: Column) -> DataFrame:
    """Groups with their codes sorted and the canonical one: of least preference, then least code."""
    return df.groupBy(*keys).agg(F.min(F.struct(preference.alias("p"), F.col(code).alias("c"))).alias("__c"), F.array_sort(F.collect_set(code)).alias("codes"), *[v.alias(k) for k, v in aggregates.items()]).withColumn("canonical", F.col("__c.c")).drop("__c")


def plan_preference(direct: Column, growth: Column) -> Column:
    """Direct growth, regular growth, growth of unknown kind, direct, others."""
    d, g = F.coalesce(direct, F.lit(False)), F.coalesce(growth, F.lit(False))
    return F.when(d & g, 0).when((~d & direct.isNotNull()) & g, 1).when(g, 2).when(d, 3).otherwise(4)


def top_weights(df: DataFrame, key: str, weight: str, n: int = 5, digits: int = 1) -> DataFrame:
    """Each key's n largest weights, rounded, as an array. Only n a key are gathered."""
    w = Window.partitionBy(key).orderBy(F.col(weight).desc(), *[F.col(c) for c in df.columns if c not in (key, weight)])
    few = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)
    return few.groupBy(key).agg(F.sort_array(F.collect_list(F.round(F.col(weight), digits)), asc=False).alias("top"))


def stratified(df: DataFrame, group: str, order: list[Column], n: int = 3) -> DataFrame:
    return nth_by(df, [group], order, n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the least hash of seed and key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def strided(df: DataFrame, group: str, order: list[Column], most: int = 24) -> DataFrame:
    """At most ``most`` rows of each group, evenly spaced in order."""
    w = Window.partitionBy(group)
    df = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    step = F.greatest(F.ceil(F.col("__n") / most), F.lit(1))
    return df.where(F.col("__i") % step == 0).drop("__i", "__n")


def mode_of(df: DataFrame, group: str, value: str) -> DataFrame:
    """The commonest value of each group; ties by the least value."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    return first_by(counts, [group], [F.col("n").desc(), F.col(value)])


def upper_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """The value at place n // 2 of each group's sorted values, by windows (no group is gathered in an array)."""
    w = Window.partitionBy(group)
    ranked = df.withColumn("__i", F.row_number().over(w.orderBy(value)) - 1).withColumn("__n", F.count("*").over(w))
    return ranked.where(F.col("__i") == F.floor(F.col("__n") / 2)).select(group, F.col(value).alias("upper_median"))
