"""Document fingerprints from closed syncmers, compared by position.

The k-mers are ``K`` bytes of UTF-8; one is an anchor where the least hash of its ``K - S + 1`` inner ``S``-mers
stands at either edge. That depends on the k-mer alone, so equal passages give equal anchors wherever they
stand. A fingerprint has ``SLOTS`` slots; an anchor belongs to the slot of its hash, each slot keeps its
least anchor with the byte position where that first occurs. Likeness is the share of used slots (of either
fingerprint) whose anchors agree and whose displacement lies near the commonest one (the median), so that scattered
chance matches count nothing.

Defined cases: null is empty; an empty text has the empty fingerprint; a text without an anchor counts as a
single anchor; two empty fingerprints are alike (1), an empty and another are not (0); with one document its
next is itself; equal ids stand in the order of their texts; null ids come last; an empty table gives no rows.
Repeated rows have equal fingerprints and stand next to each other. A very long text is read piece by piece for its
fingerprint; it and its edited text are held whole. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

K, S, SLOTS = 24, 8, 64
NEAR_BYTES = 64
PART_BYTES = 256 << 20
COARSE = 1000
HEADS = 500_000

OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _eights(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position, as integers."""
    n = len(b) - 7
    v = np.zeros(n, np.uint64)
    for i in range(8):
        v |= b[i : n + i].astype(np.uint64) << np.uint64(8 * i)
    return v


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of all closed syncmers."""
    b = np.frombuffer(raw, np.uint8)
    w = K - S + 1
    if len(b) < K:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    e = _eights(b)
    h = C.mix(e)
    m, span = h, 1
    while span < w:  # sliding least by doubling
        step = min(span, w - span)
        m = np.minimum(m[:-step], m[step:])
        span += step
    at = np.flatnonzero((h[: len(m)] == m) | (h[w - 1 :] == m))
    return C.mix(e[at] ^ C.mix(e[at + 8] ^ C.mix(e[at + 16]))), at


def fingerprint(raw: bytes, piece: int = C.SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(least hash, position) by slot; position -1: the slot is not used."""
    least, pos = np.full(SLOTS, np.iinfo(np.uint64).max), np.full(SLOTS, -1, np.int64)
    for start in range(0, max(len(raw) - K + 1, 0), piece):
        h, at = anchors(raw[start : start + piece + K - 1])
        if len(h):
            slot = (h % np.uint64(SLOTS)).astype(np.int64)
            order = np.lexsort((at, h, slot))
            first = order[np.flatnonzero(np.diff(slot[order], prepend=-1))]
            s = slot[first]
            better = (h[first] < least[s]) | (pos[s] < 0)
            least[s[better]], pos[s[better]] = h[first][better], at[first][better] + start
    if raw and (pos < 0).all():
        h = int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")
        least[h % SLOTS], pos[h % SLOTS] = h, 0
    return least, pos


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    used = (a[1] >= 0) | (b[1] >= 0)
    if not used.any():
        return 1.0
    same = (a[1] >= 0) & (b[1] >= 0) & (a[0] == b[0])
    if not same.any():
        return 0.0
    move = a[1][same] - b[1][same]
    near = np.abs(move - np.sort(move)[len(move) // 2]) <= NEAR_BYTES
    return float(near.sum() / used.sum())


def printed(f: tuple[np.ndarray, np.ndarray]) -> str:
    """hash.position in hex by slot, comma-joined; "-" for an unused slot; empty for the empty text."""
    if (f[1] < 0).all():
        return ""
    return ",".join("-" if p < 0 else f"{h:016x}.{p:x}" for h, p in zip(f[0].tolist(), f[1].tolist()))


def edited(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(batches):
    """Rows of a part come in order; a row marked as halo only serves as the next one of the row before it."""
    before, rows = None, []

    def packed():
        out = pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]))
        rows.clear()
        return out

    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            text = text or ""
            now = (doc_id, text, fingerprint(text.encode()))
            if before is not None:
                new = edited(before[1], text)
                f = fingerprint(new.encode())
                rows.append({"doc_id": before[0], "n_chars": len(before[1]), "edited_sha256": hashlib.sha256(new.encode()).hexdigest(), "fingerprint": printed(before[2]), "edited_fingerprint": printed(f), "near_edited": likeness(before[2], f), "near_next": likeness(before[2], now[2])})
            before = now
            if len(rows) >= 500:
                yield packed()
    yield packed()


def _part(part_bytes: int, docs: DataFrame):
    """The range of ids that a row belongs to, as a column, and the number of ranges.

    Up to ``COARSE`` quantiles cut the ids, each range evenly once more where more parts are needed; rows without an
    id are cut by their tie.
    """
    size, key = F.octet_length("text") + 100, F.col("key").cast("double")
    coarse = [i / COARSE for i in range(1, COARSE)]
    s = docs.agg(F.sum(size).alias("n"), F.sum(F.when(key.isNull(), size)).alias("free"), F.percentile_approx(key, coarse, 10_000).alias("q"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if s.n is None:
        return F.lit(0), 1
    spread = min(3 * docs.sparkSession.sparkContext.defaultParallelism, -(-s.n // (4 << 20)))
    of = lambda n: max(1, -(-n // part_bytes), -(-n * spread // s.n))
    free = of(s.free or 0)
    if s.low is None:
        return F.floor((F.col("tie").cast("double") / 2.0**64 + 0.5) * free).cast("int"), free + 1
    parts = of(s.n - (s.free or 0))
    step = -(-COARSE // min(parts, COARSE))
    cuts = sorted(set(s.q[step - 1 :: step]) - {s.high})
    each = -(-parts // (len(cuts) + 1)) if parts > COARSE else 1
    edges = F.array(*[F.lit(float(c)) for c in [s.low, *cuts, s.high]])
    at = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < key)) if cuts else F.lit(0)
    low, high = F.element_at(edges, at + 1), F.element_at(edges, at + 2)
    inside = F.coalesce(F.least(F.floor((key - low) / F.nullif(high - low, F.lit(0.0)) * each), F.lit(each - 1)), F.lit(0))
    known = (len(cuts) + 1) * each
    untold = known + F.floor((F.col("tie").cast("double") / 2.0**64 + 0.5) * free)
    return F.when(key.isNull(), untold).otherwise(at * each + F.greatest(inside, F.lit(0))).cast("int"), known + free + 1


def compare(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's (descending id).

    Texts move once, into ranges of ids; each range also gets the row that follows it (its halo), found by a table of
    the ranges' first rows, which is broadcast up to ``HEADS`` ranges (counted).
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # descending ids, nulls last; equal ids by hash of the text
    docs = docs.withColumn("key", -F.col("doc_id").cast("decimal(20,0)")).withColumn("tie", F.xxhash64("text"))
    part, parts = _part(part_bytes, docs)
    docs = docs.withColumn("part", part)
    heads = C.staged(docs.groupBy("part").agg(F.min(F.struct("key", "tie")).alias("head")))
    n = heads.count()
    # a range's first row also goes to the range before it, the very first one to the last: one small row a range
    before = F.lag("part").over(Window.orderBy("part"))
    last = heads.agg(F.max("part").alias("last"))
    halo = heads.withColumn("to", before).join(F.broadcast(last)).select("part", F.coalesce("to", "last").alias("to"), F.col("head.key").alias("hkey"), F.col("head.tie").alias("htie"))
    halo = F.broadcast(halo) if n <= HEADS else halo
    extra = docs.join(halo, "part").where(F.col("key").eqNullSafe(F.col("hkey")) & (F.col("tie") == F.col("htie"))).dropDuplicates(["to"])
    extra = extra.select("doc_id", "text", "key", "tie", F.col("to").alias("part"), F.lit(1).alias("halo"))
    both = docs.select("doc_id", "text", "key", "tie", "part", F.lit(0).alias("halo")).unionByName(extra)
    ordered = both.repartitionById(parts, F.col("part")).sortWithinPartitions("halo", F.col("key").asc_nulls_last(), "tie")
    return ordered.select("doc_id", "text").mapInArrow(C.released(_compare), OUT)
