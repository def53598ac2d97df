"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Features are word and punctuation tokens (ASCII letters lower-cased) and their bigrams, hashed into
``buckets`` cells. Raw counts cover every document; the target's counts come from documents with
``labels.quality = 1`` among at most ``max_labelled`` labelled ones (those with the least hashed id), the
bound of the fit. A document scores the mean over its features of log p_target - log p_raw; the verdict
holds where the score reaches a threshold: the middle of the gap that parts the labelled good from the
labelled bad best (ties: the widest), among those that pass the base rule.

Defined cases: a null or wordless text has no features, scores 0 and fails the base rule; repeated rows are
judged one by one, and labels of one id count once (the lesser quality); no labels of either kind: every document's
verdict is true; ties of thresholds go to the widest gap; an empty table gives no rows; a very long text is judged
whole, as a slice of its own; further columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
MIN_WORDS = 50
REPEAT_PERCENT = 50

_CLASS = np.full(256, 1, np.uint8)  # 0 separator, 1 letters, digits and non-ASCII, 2 punctuation
_CLASS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 2
_CLASS[C.SEPARATOR] = 0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, and the document of each."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    cuts = np.flatnonzero(change)
    s, e = cuts[:-1], cuts[1:]
    full = kind[s] > 0
    s, e = s[full], e[full]
    h = C.range_hashes(C.LOWER[data], s, e)
    doc = np.searchsorted(offsets, s, "right") - 1
    pair = doc[1:] == doc[:-1]
    two = C.mix(h[:-1] * np.uint64(3) + C.mix(h[1:]))[pair]
    return (np.concatenate([h, two]) % np.uint64(buckets)).astype(np.int64), np.concatenate([doc, doc[1:][pair]])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The rule columns of every document. Equal lines and windows are found by hash and confirmed by their bytes."""
    starts, ends, first = C.words(data, offsets)
    n_docs = len(offsets) - 1
    chars = C.run_sums(((data & 0xC0) != 0x80) & ~C.SEPARATOR[data], offsets)
    symbols = C.run_sums(_SYMBOL[data], offsets)
    # lines: every \n and every document's start opens one
    cut = np.flatnonzero(data == 10)
    ls = np.union1d(offsets[:-1], cut + 1)
    ls = ls[ls < len(data)]
    ldoc = np.searchsorted(offsets, ls, "right") - 1
    le = np.minimum(np.append(ls[1:], len(data)), offsets[ldoc + 1])
    le = le - ((le > ls) & (data[le - 1] == 10))
    worded = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, ldoc = ls[worded], le[worded], ldoc[worded]
    lines = np.bincount(ldoc, minlength=n_docs)
    content = C.distinct_ranges(data, ls, le)[1]
    _, at = np.unique(content * n_docs + ldoc, return_index=True)
    dup = lines - np.bincount(ldoc[at], minlength=n_docs)
    # words inside 3-word windows that occur twice
    wdoc = C.owner(first)
    rep = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        h = C.window_hashes(C.range_hashes(data, starts, ends), 3)
        ok = np.flatnonzero(wdoc[2:] == wdoc[:-2])
        order = ok[np.lexsort((h[ok], wdoc[ok]))]
        group = np.cumsum(np.append(True, (h[order][1:] != h[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1]))[: len(order)]) - 1
        if _collided(data, starts, ends, order, group):
            word = C.distinct_ranges(data, starts, ends)[1]
            two = np.unique(word[:-1] * len(starts) + word[1:], return_inverse=True)[1]
            key = np.unique(two[:-1] * len(starts) + word[2:], return_inverse=True)[1]
            group = np.unique(key[order] * n_docs + wdoc[order], return_inverse=True)[1]
        at = order[np.bincount(group)[group] > 1]
        for k in range(3):
            rep[at + k] = True
    return {"n_words": np.diff(first), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": C.run_sums(rep, first)}


def _collided(data, starts, ends, order, group) -> bool:
    """Whether 3-word windows that are neighbours of one group differ in a word."""
    same = np.flatnonzero(group[1:] == group[:-1])
    a, b = order[same], order[same + 1]
    return any(not C.equal_ranges(data, starts[a + k], ends[a + k], starts[b + k], ends[b + k]).all() for k in range(3))


def _base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])


def _count(labelled: dict[int, int], buckets: int):
    good = np.array(sorted(k for k, v in labelled.items() if v == 1), np.int64)

    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            known = np.asarray(b.column("doc_id").is_valid())
            is_good = known & np.isin(np.asarray(b.column("doc_id").fill_null(0)), good)
            for i, j in C.slices(offsets):
                f, d = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], buckets)
                raw += np.bincount(f, minlength=buckets)
                target += np.bincount(f[is_good[i:j][d]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int32), "raw": raw[at], "target": target[at]})

    return run


def _scores(data, offsets, ratio):
    f, d = features(data, offsets, len(ratio))
    n = np.bincount(d, minlength=len(offsets) - 1)
    return np.bincount(d, weights=ratio[f], minlength=len(offsets) - 1) / np.maximum(n, 1)


def _score(ratio: np.ndarray):
    def run(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            for i, j in C.slices(offsets):
                d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                ok = ~_base_failed(base_counts(d, o))
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(i, j - i).cast(pa.int64()), "quality": b.column("quality").slice(i, j - i), "score": _scores(d, o, ratio)}).filter(pa.array(ok))

    return run


def _judge(ratio: np.ndarray, threshold: float):
    def run(batches):
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            ids = b.column("doc_id")
            for i, j in C.slices(offsets):
                d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                c = base_counts(d, o)
                failed = _base_failed(c)
                s = _scores(d, o, ratio)
                cols = {"doc_id": ids.slice(i, j - i).cast(pa.int64()), **{k: v.astype(np.int64) for k, v in c.items()}, "base_failed": failed, "score": s, "kept": ~failed & (s >= threshold)}
                yield pa.RecordBatch.from_pydict(cols)

    return run


def best_threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the gap between neighbouring scores that parts good from bad best (ties: the widest gap)."""
    if len(good) == 0 or len(bad) == 0:
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([good, bad]))
    if len(cuts) == 1:
        return -np.inf
    low, high = cuts[:-1], cuts[1:]
    gain = np.searchsorted(bad, low, "right") / len(bad) - np.searchsorted(good, low, "right") / len(good)
    at = np.lexsort((high - low, gain))[-1]
    return float((low[at] + high[at]) / 2)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, float]:
    """(log ratio of each bucket, threshold). Driver memory: ``buckets`` counts and ``max_labelled`` labels."""
    docs = docs.select("doc_id", "text")
    rows = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    labelled = {r.doc_id: r.quality for r in rows.collect()}
    counted = docs.mapInArrow(C.released(_count(labelled, buckets)), "bucket int, raw long, target long")
    total = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(buckets), np.zeros(buckets)
    raw[total.bucket] += total.raw
    target[total.bucket] = total.target
    p_raw = raw / raw.sum()
    smooth = 0.05 * max(target.sum(), 1.0) + 1.0  # the raw model is the prior of the target
    ratio = np.log((target + smooth * p_raw) / (target.sum() + smooth)) - np.log(p_raw)
    if not labelled:
        return ratio, -np.inf
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(list(labelled.items()), "doc_id long, quality int"))  # max_labelled rows at most
    scored = docs.join(few, "doc_id").select("doc_id", "text", "quality").mapInArrow(C.released(_score(ratio)), "doc_id long, quality int, score double")
    seen = scored.groupBy("doc_id", "quality").agg(F.min("score").alias("score")).toPandas()  # max_labelled rows at most, however often an id is repeated
    return ratio, best_threshold(seen.score[seen.quality == 1].to_numpy(), seen.score[seen.quality == 0].to_numpy())


def judge(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Rule columns, score and verdict of every document."""
    ratio, threshold = fit(docs, labels, **params)
    return docs.select("doc_id", "text").mapInArrow(C.released(_judge(ratio, threshold)), OUT)


def keep(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents whose verdict is true, with their columns."""
    ratio, threshold = fit(docs, labels, **params)
    decide = _judge(ratio, threshold)

    def run(batches):
        for b in batches:
            ok = pa.concat_arrays([x.column("kept") for x in decide([b])]) if b.num_rows else pa.array([], pa.bool_())
            yield b.filter(ok)

    return docs.mapInArrow(C.released(run), docs.schema)
