"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A document's expected copies e is its source's ratio target / size. With ``tilt`` (off: 0) it is moved by a priority
that favours short documents without moving the source's total and without leaving [0, ``cap``]. Its floor(e) whole copies are certain; one more is drawn with inclusion odds f / (1 - f), f the
fraction of e: documents of a source are ranked by their random odds U / (1 - U) over the inclusion odds, and
the sample's size is fixed in words: the prefix of that order whose words come nearest to what is left of the
target. U is a hash of seed and id, so reruns agree. The cut-off rank is found by two rounds of 1024-fold
bucket sums, then exactly in one bucket: no source is gathered in one task.

Defined cases: a null text has size 0 and is never taken; null is a source of its own, last in order; a null
id is hashed as null; rows with equal ids share their rank; an empty table gives an empty result; a source of
size 0 has target 0; repeated rows are drawn alike; a very long text is one row of its size. Other columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17
TILT = 0.0
FANOUT = 1024
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _priority(size: Column, tilt: float) -> Column:
    """In (1, 1 + tilt]: larger for short documents."""
    return 1 + tilt / (1 + size / 1000.0)


def _uniform(doc_id: str, seed: int) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def targets(base: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, tilt: float = TILT) -> DataFrame:
    """(source, source_size, mean_priority, target) from (source, size): weights by the sources' order, water-filled up to ``cap`` times the size."""
    by = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * _priority(F.col("size"), tilt)).alias("p"))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(n - 1, F.lit(len(weights))) + 1)
    by = by.withColumn("weight", weight).withColumn("limit", cap * F.col("source_size").cast("double"))
    by = by.withColumn("ratio", F.col("limit") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    by = by.withColumn("level", left / open_weight)  # words per unit of weight if this source and those after it are open
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(whole)
    by = by.withColumn("level", F.min(F.when(F.col("ratio") == fits, F.col("level"))).over(whole))
    target = F.least(F.coalesce(F.col("weight") * F.col("level"), F.lit(0.0)), F.col("limit"))
    return by.select("source", "source_size", (F.col("p") / F.greatest("source_size", F.lit(1))).alias("mean_priority"), target.alias("target"))


def _expected(cap: int, tilt: float) -> Column:
    r = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    e = r + (_priority(F.col("size"), tilt) / F.col("mean_priority") - 1) * F.least(r, cap - r) if tilt else r
    return F.when(F.col("size") > 0, F.least(F.greatest(e, F.lit(0.0)), F.lit(float(cap)))).otherwise(0.0)


def _ranked(base: DataFrame, sources: DataFrame, n_sources: int, cap: int, seed: int, tilt: float) -> DataFrame:
    """``base`` with its source's columns, sure copies and rank in (0, 1); no fraction: rank null."""
    df = C.small_or_salted_join(base, sources, "source", n_sources)
    df = df.withColumn("e", _expected(cap, tilt))
    df = df.withColumn("sure", F.floor(F.col("e") + 1e-9)).withColumn("f", F.greatest(F.col("e") - F.col("sure"), F.lit(0.0)))
    u = _uniform("doc_id", seed)
    odds = u / (1 - u) * (1 - F.col("f")) / F.col("f")
    return df.withColumn("rank", F.when(F.col("f") > 1e-9, odds / (1 + odds)))


def _cut(parts: DataFrame, keys: str, bucket: Column) -> DataFrame:
    """Per source, the bucket that the words left reach into, and the words left in it."""
    sums = parts.groupBy("source", "left", bucket.alias(keys)).agg(F.sum("size").alias("w"))
    before = F.coalesce(F.sum("w").over(Window.partitionBy("source").orderBy(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("rest", F.col("left") - before).where("rest > 0")
    return sums.groupBy("source").agg(F.max(keys).alias(keys), F.min("rest").alias("left"))


def cutoffs(base: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, tilt: float = TILT) -> tuple[DataFrame, int]:
    """Per source its size, target and the last rank that is taken (-1: none), as a staged table, and its row count."""
    sources = C.staged(targets(base, weights, cap, tilt))
    n = sources.count()
    ranked = _ranked(base, sources, n, cap, seed, tilt)
    sure = ranked.groupBy("source", "target").agg(F.sum(F.col("sure") * F.col("size")).alias("got"))
    left = C.staged(sure.select("source", (F.col("target") - F.col("got")).alias("left")))
    drawn = ranked.where("rank is not null").select("source", "size", "rank", "doc_id")
    one, two = F.floor(F.col("rank") * FANOUT), F.floor(F.col("rank") * FANOUT * FANOUT)
    first = C.staged(_cut(C.small_or_salted_join(drawn, left, "source", n), "one", one))
    inside = C.small_or_salted_join(drawn, first, "source", n).where(one == F.col("one"))
    second = C.staged(_cut(inside, "two", two))
    inside = C.small_or_salted_join(drawn, second, "source", n).where(two == F.col("two"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id")
    ends = inside.withColumn("gap", F.sum("size").over(order) - F.col("left"))  # rows of equal rank and id stand together
    best = ends.groupBy("source").agg(F.min_by("rank", F.struct(F.abs("gap"), "rank")).alias("last"), F.min(F.abs("gap")).alias("off"), F.first("left").alias("left"))
    # nothing of the last bucket comes nearest: all ranks below it
    floor = C.small_or_salted_join(best, second.select("source", "two"), "source", n)
    last = F.when(F.col("off") < F.col("left"), F.col("last")).otherwise(F.col("two") / float(FANOUT * FANOUT) - 1e-15)
    cut = floor.select("source", last.alias("last"))
    out = C.small_or_salted_join(sources, cut, "source", n).withColumn("last", F.coalesce("last", F.lit(-1.0)))
    return C.staged(out), n


def plan(base: DataFrame, cuts: DataFrame, n_sources: int, cap: int = CAP, seed: int = SEED, tilt: float = TILT) -> DataFrame:
    """``base`` (doc_id, source, size) with source_size, target and copies."""
    df = _ranked(base, cuts, n_sources, cap, seed, tilt)
    copies = F.col("sure") + F.coalesce((F.col("rank") <= F.col("last")).cast("int"), F.lit(0))
    return df.withColumn("copies", copies.cast("long"))


def mixture(docs: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    base = C.staged(docs.select("doc_id", "source", word_count().alias("size")))
    cuts, n = cutoffs(base, **params)
    return plan(base, cuts, n, **{k: v for k, v in params.items() if k != "weights"}).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns."""
    base = C.staged(docs.select("doc_id", "source", word_count().alias("size")))
    cuts, n = cutoffs(base, **params)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", word_count().alias("size"))
    taken = plan(packed, cuts, n, **{k: v for k, v in params.items() if k != "weights"}).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
