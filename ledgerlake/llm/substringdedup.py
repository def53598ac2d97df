"""Substring dedup over words by prefix-partitioned suffix trees.

Candidate texts come from ``repeats`` (buckets of anchors, dealt to tasks). In a task, the suffixes that start a
window are split by prefixes of variable length: a group of suffixes that share a prefix and exceed ``MEMORY``
suffixes is split by a prefix twice as long, up to the whole window. Suffixes reach to their run's end. Each
group's subtree is built over its sorted suffixes from the lengths of their shared prefixes; its internal nodes of
``WIDTH`` words or more are the maximal repeats, their leaves the occurrences. Windows below one such node that has
no deep parent are equal.

Defined cases: null has no words; texts of fewer than ``WIDTH`` words keep all; a null id counts as larger than
any; repeated rows (equal id and text) don't remove each other, nor do rows of one id; very long texts are hashed
piece by piece (8 bytes a word are held) and read in overlapping pieces; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C
from . import repeats

WIDTH, GRAM = 50, 8
MEMORY = 16_384
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def prefix_groups(ranks: np.ndarray, at: np.ndarray, width: int, memory: int = MEMORY):
    """Groups of indexes into ``at`` whose suffixes share a prefix, and the prefix's length; small groups go together."""
    base = int(ranks.max(initial=0)) + 1
    todo = [(np.arange(len(at)), 0)]
    while todo:
        idx, size = todo.pop()
        longer = min(max(1, 2 * size), width)
        group = np.zeros(len(idx), np.int64)
        for k in range(size, longer):
            group = np.unique(group * base + ranks[at[idx] + k], return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
        held, n = [], 0
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            part = idx[order[a:b]]
            if b - a > memory and longer < width:
                todo.append((part, longer))
                continue
            held.append(part)
            n += len(part)
            if n >= memory:
                yield np.concatenate(held), longer
                held, n = [], 0
        if held:
            yield np.concatenate(held), longer


def subtree(ranks: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared prefix lengths) of the suffixes of ``size`` words from ``at``, sorted word by word: the leaves of their subtree and the depths between them."""
    width = int(size.max(initial=1))
    k = np.arange(width)
    rows = np.where(k < size[:, None], ranks[np.minimum(at[:, None] + k, len(ranks) - 1)] + 1, 0).astype(">u4")
    order = np.argsort(rows.view(f"V{4 * width}").ravel(), kind="stable")
    ranked, size = rows[order], size[order]
    same = ranked[1:] == ranked[:-1]
    depth = np.where(same.all(1), width, np.argmin(same, 1))
    return order, np.concatenate([[0], np.minimum(depth, np.minimum(size[1:], size[:-1]))])


def deep_nodes(depth: np.ndarray, width: int) -> list[tuple[int, int, int, int]]:
    """(first leaf, end, depth in words, parent or -1) of the subtree's internal nodes of ``width`` words or more: its maximal repeats and their occurrences. A parent stands before its children."""
    nodes: list[list[int]] = []
    starts, ends = np.flatnonzero((depth >= width) & (np.append(0, depth[:-1]) < width)), np.flatnonzero((depth >= width) & (np.append(depth[1:], 0) < width)) + 1
    for a, b in zip((starts - 1).tolist(), ends.tolist()):
        first = len(nodes)
        stack: list[list[int]] = []
        d = depth[a + 1 : b].tolist()
        for i, h in enumerate(d, a):
            left = i
            while stack and stack[-1][2] > h:
                top = stack.pop()
                top[1], left = i + 1, top[0]
                nodes.append(top)
            if not stack or stack[-1][2] < h:
                stack.append([left, -1, h, -1])
        while stack:
            stack[-1][1] = b
            nodes.append(stack.pop())
        mine = sorted(nodes[first:], key=lambda x: (x[0], -x[1], x[2]))
        open_: list[int] = []
        for i, x in enumerate(mine, first):
            while open_ and mine[open_[-1] - first][1] <= x[0]:
                open_.pop()
            x[3] = open_[-1] if open_ else -1
            open_.append(i)
        nodes[first:] = mine
    return [tuple(x) for x in nodes]


def classes(values: np.ndarray, begin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A class for every window start: the highest internal node of window depth above it, or the leaf itself."""
    ranks = np.unique(values, return_inverse=True)[1].astype(np.int64)
    end = np.append(begin[1:], len(values))
    size = end[np.searchsorted(begin, at, "right") - 1] - at
    out = np.zeros(len(at), np.int64)
    n = 0
    for idx, _ in prefix_groups(ranks, at, WIDTH):
        order, depth = subtree(ranks, at[idx], size[idx])
        node = np.arange(len(idx))
        for a, b, _, parent in deep_nodes(depth, WIDTH):
            if parent < 0:
                node[a:b] = a
        out[idx[order]] = n + node
        n += len(idx)
    return np.unique(out, return_inverse=True)[1]


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return C.word_hashes(data, offsets)


def spans(docs: DataFrame, **params) -> DataFrame:
    """(key, spans) of the word ranges that windows of lesser documents cover."""
    return repeats.covered(docs, units, classes, np.uint64, WIDTH, GRAM, by_least=True, twins=True, **params)


def _cut(batches):
    for b in batches:
        data, offsets = C.text_bytes(b.column("text"))
        cols = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept")}
        for i, s in enumerate(repeats.span_columns(b)):
            words = data[offsets[i] : offsets[i + 1]].tobytes().translate(_TO_SPACE).split(b" ")
            words = [w for w in words if w]
            gone = repeats.flags(s, len(words)) if s is not None else None
            kept = b" ".join(words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g])
            cols["n_words"].append(len(words))
            cols["n_removed"].append(0 if gone is None else int(gone.sum()))
            cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            cols["kept"].append(kept.decode())
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").cast(pa.int64())} | cols)


_TO_SPACE = bytes(32 if C.SEPARATOR[i] else i for i in range(256))


def dedup(docs: DataFrame, **params) -> DataFrame:
    """doc_id, counts, digest and the kept text of every document."""
    return repeats.with_spans(docs, spans(docs, **params)).mapInArrow(_cut, OUT + ", kept string")


def digest(docs: DataFrame, **params) -> DataFrame:
    return dedup(docs, **params).select("doc_id", "n_words", "n_removed", "kept_sha256")
