"""Hard negatives by a full sort of every anchor's scores.

Vectors are quantised to integers, so every score is an exact integer inner product. Rows and anchors are dealt to
blocks of a bounded size, by row number, so that no id, label or copy makes one large; a task holds one block of
either side.

1. In each block every anchor's same-label scores are sorted; the first ``positives`` of all blocks are its positives.
2. In each block every anchor's scores are lexsorted by score and id; each positive's upper limit is found in them by
   binary search, and the first ``k`` entries of another label at or below it that reach the lower limit are read. The
   first ``k`` of all blocks are the answer, since each of them is among the first ``k`` of its own block.

Scores are multiplied in floating point where every partial sum is below 2^53, thus exact, else in 64-bit integers.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part, nor do those
whose sum of squares after quantising reaches 2^63, beyond which a score may not fit a long; a missing component
of a shorter vector counts as 0; a null id is no anchor, comes last among ties and is reported as null; equal scores
are ordered by id; repeated rows are rows of their own, as anchors, positives and negatives, and the copy of an anchor
is one of its other rows; an empty table, or one without anchors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .repeats import LAST

BLOCK = 65_536
ANCHORS = 65_536
AT_ONCE = 2_000_000
SCALE = 256


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id (null: the largest), label, q (array of integers) of the rows that take part, with a row number, staged."""
    x = F.col("embedding")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    power = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.pow(F.abs(v.cast("double")) * scale + 1, F.lit(2.0)))
    rows = table.where(F.col("label").isNotNull() & x.isNotNull() & ~odd).where(power < float(1 << 63))
    vec_id = F.col("vec_id").cast("long")
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = rows.select(vec_id.alias("vec_id"), F.col("label").cast("long").alias("label"), q.alias("q"))
    return C.staged(rows.select(F.monotonically_increasing_id().alias("rn"), "vec_id", "label", "q"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors as rows of ``dims`` integers, shorter ones filled up with 0."""
    column = column.combine_chunks()
    off = np.asarray(column.offsets).astype(np.int64)
    flat = np.asarray(column.values).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    if len(out) and dims:
        size = np.diff(off)
        at = np.arange(dims)
        have = at < size[:, None]
        out[have] = flat[off[0] : off[-1]]
    return out


def _dims(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(np.asarray(c.combine_chunks().offsets)).max(initial=0)) for c in columns if len(c)), default=0)


def _scored(rows: pa.Table, anchors: pa.Table):
    """(ids, labels, row numbers of the block in order of id; then (range of anchors, their scores) one piece after another)."""
    dims = _dims(rows.column("q"), anchors.column("q"))
    ids = np.asarray(rows.column("vec_id").combine_chunks().fill_null(LAST))
    order = np.argsort(ids, kind="stable")
    r, a = _matrix(rows.column("q"), dims)[order], _matrix(anchors.column("q"), dims)
    most = lambda m: float((m.astype(np.float64) ** 2).sum(1).max(initial=0)) ** 0.5
    if most(r) * most(a) < 2.0**52:
        r, a = r.astype(np.float64), a.astype(np.float64)
    step = max(1, AT_ONCE // max(1, len(ids)))

    def pieces():
        for i in range(0, len(a), step):
            s = a[i : i + step] @ r.T
            yield i, s.astype(np.int64)

    return ids[order], np.asarray(rows.column("label"))[order], np.asarray(rows.column("rn"))[order], pieces()


def _positives(count: int):
    schema = pa.schema([("rn", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            ids, label, rn, pieces = _scored(rows, anchors)
            a_rn, a_label = np.asarray(anchors.column("rn")), np.asarray(anchors.column("label"))
            of = {v: np.flatnonzero(label == v) for v in np.unique(a_label).tolist()}
            for i, scores in pieces:
                for k, s in enumerate(scores, i):
                    same = of[int(a_label[k])]
                    same = same[np.argsort(-s[same], kind="stable")]
                    same = same[: count + 1]
                    same = same[rn[same] != a_rn[k]][:count]
                    out.append((np.full(len(same), a_rn[k]), ids[same], s[same]))
        if not out:
            return schema.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], schema=schema)

    return run


def _negatives(k: int, low: int, high: int):
    schema = pa.schema([("rn", pa.int64()), ("anchor_id", pa.int64()), ("no", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            ids, label, _, pieces = _scored(rows, anchors)
            a_rn, a_id, a_label = (np.asarray(anchors.column(c)) for c in ("rn", "vec_id", "label"))
            found = anchors.column("found").to_pylist()
            for i, scores in pieces:
                for n, s in enumerate(scores, i):
                    order = np.argsort(-s, kind="stable")  # of equal scores the least id is first
                    order = order[label[order] != a_label[n]]
                    down = -s[order]
                    for p in found[n]:
                        score = p["score"]
                        most, least = high * score // 100, -(-low * score // 100)
                        if least > most:
                            continue
                        begin, end = np.searchsorted(down, -most, "left"), np.searchsorted(down, -least, "right")
                        hit = order[begin : min(int(end), int(begin) + k)]
                        if len(hit):
                            out.append((*(np.full(len(hit), v) for v in (a_rn[n], a_id[n], p["no"], p["id"], score)), ids[hit], s[hit]))
        if not out:
            return schema.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], schema=schema)

    return run


def mine(rows: DataFrame, anchors: DataFrame, k: int = 10, positives: int = 5, low: int = 30, high: int = 90, block: int = BLOCK, at_most: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``quantised`` rows and some of them as anchors.

    Negatives are rows of another label whose score is between ``low`` and ``high`` percent of the positive's.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_i = max(2 * cores, -(-rows.count() // block))
    n_j = max(1, -(-anchors.count() // at_most))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n: F.pmod(F.xxhash64("rn"), F.lit(n)).cast("int")
    by_block = rows.withColumn("i", of(n_i)).withColumn("j", every(n_j)).groupBy("i", "j")
    placed = lambda a: a.withColumn("j", of(n_j)).withColumn("i", every(n_i)).groupBy("i", "j")

    first = by_block.cogroup(placed(anchors)).applyInArrow(_positives(positives), "rn long, id long, score long")
    order = [F.col("score").desc(), F.col("id")]
    first = first.withColumn("no", F.row_number().over(Window.partitionBy("rn").orderBy(*order))).where(F.col("no") <= positives)
    found = first.groupBy("rn").agg(F.sort_array(F.collect_list(F.struct(F.col("no").cast("long").alias("no"), "id", "score"))).alias("found"))
    asked = C.staged(anchors.join(found, "rn"))
    near = by_block.cogroup(placed(asked)).applyInArrow(_negatives(k, low, high), "rn long, anchor_id long, no long, positive_id long, positive_score long, id long, score long")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("rn", "no").orderBy(*order))).where(F.col("rank") <= k)
    known = lambda c: F.nullif(F.col(c), F.lit(LAST))
    return near.select("anchor_id", known("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(table: DataFrame, every: int = 100, **params) -> DataFrame:
    """``mine`` over a table of vectors, with the rows whose id is divisible by ``every`` as anchors."""
    rows = quantised(table)
    return mine(rows, rows.where(F.col("vec_id") % every == 0), **params)
