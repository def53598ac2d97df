"""Suffix-array dedup of byte strings by bucket-pointer refinement.

Candidate texts come from ``repeats`` (buckets of anchors, dealt to tasks). In a task, every position's bucket
starts as that of its first 8 bytes; buckets are refined by sorting on the bucket identifiers at a later offset,
8, 16, 32, 64 and 128 bytes on, each round reusing the identifiers updated by the round before, until equal
buckets mean equal strings of ``WIDTH`` bytes. A bucket of one position is final and leaves the sort.

Defined cases: null is empty; texts of fewer than ``WIDTH`` bytes keep all; repeated rows are copies of each
other and lose every byte that such a string covers; rows without an id are rows like others; ties don't arise; very
long texts are read in overlapping pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from . import repeats

WIDTH, GRAM = 200, 32
TWINS = False  # two copies of every repeated run cost more disk and time than the job's budget
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def refine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Buckets by pairs of bucket identifiers; -1: a bucket of one position (or a position that has none)."""
    out = np.full(len(first), -1, np.int64)
    live = np.flatnonzero((first >= 0) & (second >= 0))
    if len(live) == 0:
        return out
    key = first[live] * np.int64(len(first) + 1) + second[live]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.empty(len(ranked), bool)
    new[0], new[1:] = True, ranked[1:] != ranked[:-1]
    last = np.append(new[1:], True)
    head = np.flatnonzero(new)
    out[live[order]] = np.where(new & last, -1, head[np.cumsum(new) - 1])
    return out


def buckets(values: np.ndarray, width: int = WIDTH, q: int = 8) -> np.ndarray:
    """The bucket of every position's next ``width`` bytes; -1 where it is the only one. The last q - 1 positions have none."""
    n = len(values)
    if n < q:
        return np.full(n, -1, np.int64)
    word = np.zeros(n - q + 1, np.uint64)
    for i in range(q):
        word |= values[i : n - q + 1 + i].astype(np.uint64) << np.uint64(8 * (q - 1 - i))
    order = np.argsort(word, kind="stable")
    ranked = word[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    head = np.flatnonzero(new)
    b = np.full(n, -1, np.int64)
    b[order] = np.where(new & np.append(new[1:], True), -1, head[np.cumsum(new) - 1])
    depth = q
    while depth < width:
        step = min(depth, width - depth)
        later = np.full(n, -1, np.int64)
        later[:-step] = b[step:]
        b = refine(b, later)
        depth += step
    return b


def classes(values: np.ndarray, begin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A class for every window start: equal for equal windows."""
    b = buckets(values)[at]
    alone = b < 0
    b[alone] = len(values) + np.arange(int(alone.sum()))
    return np.unique(b, return_inverse=True)[1]


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def spans(docs: DataFrame, **params) -> DataFrame:
    """(key, spans) of the byte ranges that repeated strings cover."""
    return repeats.covered(docs, units, classes, np.uint8, WIDTH, GRAM, by_least=False, **{"twins": TWINS, **params})


def _cut(batches):
    for b in batches:
        data, offsets = C.text_bytes(b.column("text"))
        cols = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for i, s in enumerate(repeats.span_columns(b)):
            raw = data[offsets[i] : offsets[i + 1]]
            gone = repeats.flags(s, len(raw)) if s is not None else np.zeros(len(raw), bool)
            kept = raw[~gone].tobytes()
            cols["n_bytes"].append(len(raw))
            cols["n_removed"].append(int(gone.sum()))
            cols["n_spans"].append(len(repeats.intervals(gone)[0]))
            cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            cols["kept"].append(kept)
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").cast(pa.int64())} | cols)


def dedup(docs: DataFrame, **params) -> DataFrame:
    """doc_id, counts, digest and the kept bytes of every document."""
    return repeats.with_spans(docs, spans(docs, **params)).mapInArrow(_cut, OUT + ", kept binary")


def digest(docs: DataFrame, **params) -> DataFrame:
    return dedup(docs, **params).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
