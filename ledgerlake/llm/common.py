"""Shared kernels: staging tables in the shared folder, Arrow text buffers, words and rolling hashes.

All byte kernels treat a null text as empty. Words are maximal runs of bytes outside
``0x20, 0x09-0x0D``; since those are ASCII, splitting UTF-8 bytes equals splitting characters.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stages import delete, drop_stage, forget, shared_folder, staged  # noqa: F401

SLICE_BYTES = 1 << 18


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer splits than cores, a small one therefore, is dealt to all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def released(run):
    """A task's function that gives its memory back when it ends; workers live on for later stages."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return whole


# ---------------------------------------------------------------- Arrow text


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n + 1 offsets); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges (i, j) of documents of about ``limit`` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


# ---------------------------------------------------------------- hashing

_LONG = 512
_SEED = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (1 << 64) - 1], np.uint64))[0])


def fold(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The hash of a sequence that hashed to ``h``, with one more value; a bijection of either argument."""
    h = (h ^ x) * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as integers, zeros beyond the end: a view, not a copy for each."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes data[start:end], folded 8 bytes at a time (long ranges: by xxh3)."""
    size = np.asarray(ends) - np.asarray(starts)
    h = fold(np.full(len(size), _SEED), size.astype(np.uint64))
    v = eights(data)
    live = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left = np.asarray(starts)[live], size[live]
    while len(live):
        h[live] = fold(h[live], v[at] & _MASK[np.minimum(left, 8)])
        more = np.flatnonzero(left > 8)
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(np.ascontiguousarray(data[starts[i] : ends[i]]))
    return mix(h)


def equal_ranges(data: np.ndarray, s: np.ndarray, e: np.ndarray, s2: np.ndarray, e2: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
    """Whether data[s:e] and data[s2:e2] (of ``other``, if given, which has 8 bytes to spare) hold the same bytes, pair by pair."""
    same = (e - s) == (e2 - s2)
    v = eights(data)
    u = v if other is None else np.ndarray((len(other) - 7,), "<u8", other, 0, (1,))
    there = data if other is None else other
    known = (s == s2) if other is None else np.zeros(len(s), bool)
    live = np.flatnonzero(same & ~known & (e > s) & (e - s <= _LONG))
    a, b, left = s[live], s2[live], (e - s)[live]
    while len(live):
        differ = ((v[a] ^ u[b]) & _MASK[np.minimum(left, 8)]) != 0
        same[live[differ]] = False
        more = np.flatnonzero(~differ & (left > 8))
        live, a, b, left = live[more], a[more] + 8, b[more] + 8, left[more] - 8
    for i in np.flatnonzero(same & ~known & (e - s > _LONG)).tolist():
        same[i] = bool((data[s[i] : e[i]] == there[s2[i] : e2[i]]).all())
    return same


def distinct_ranges(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one range of each different content, the content of every range); equal hashes are compared byte by byte."""
    if len(s) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, first, back = np.unique(range_hashes(data, s, e), return_index=True, return_inverse=True)
    odd = np.flatnonzero(~equal_ranges(data, s, e, s[first[back]], e[first[back]]))
    if len(odd):  # different contents of one hash
        more: dict[bytes, int] = {}
        extra = []
        for i in odd.tolist():
            k = more.setdefault(data[s[i] : e[i]].tobytes(), len(first) + len(extra))
            if k == len(first) + len(extra):
                extra.append(i)
            back[i] = k
        first = np.append(first, extra)
    return first, back


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive values (none where there are fewer); bytes are folded 8 at a time."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, mix_int(width), np.uint64)
    if values.dtype == np.uint8:
        v = eights(values)
        for k in range(0, width - 7, 8):
            h = fold(h, v[k : k + n])
        if width % 8:
            h = fold(h, v[width // 8 * 8 : width // 8 * 8 + n] & _MASK[width % 8])
        return h
    for k in range(width):
        h = fold(h, values[k : k + n])
    return h


def wide_hashes(grams: np.ndarray, gram: int, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` values from each place ``at``, out of the hashes of all windows of ``gram`` values."""
    h = np.full(len(at), mix_int(width), np.uint64)
    for k in [*range(0, width - gram, gram), width - gram]:
        h = fold(h, grams[at + k])
    return h


class Remembered:
    """Ids of pieces by their bytes, over slices and tasks of a worker: sorted hashes, a large and a small level of them, over pools of bytes and of ids.

    A hit is compared byte by byte. At most ``most`` pieces of up to 64 bytes are held, about 40 bytes each; then all go.
    """

    def __init__(self, dtype, most: int = 700_000):
        self.dtype, self.most = np.dtype(dtype), most
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        self.levels = [none, none]
        self.raw, self.ids = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, self.dtype)
        self.raw_used = self.ids_used = 0

    def look_up(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the different pieces data[s:e] one after another, numbers of ids); ``encode`` gives the lists of ids of those at some indexes."""
        if len(self.levels[0][0]) + len(self.levels[1][0]) > self.most:
            self.forget()
        h = range_hashes(data, s, e)
        at, n = np.full(len(s), -1, np.int64), np.zeros(len(s), np.int64)
        for known, place, size, first, count in self.levels:
            if len(known):
                k = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = np.flatnonzero((known[k] == h) & (at < 0))
                k = k[hit]
                begin = place[k].astype(np.int64)
                same = equal_ranges(data, s[hit], e[hit], begin, begin + size[k], self.raw)
                at[hit[same]], n[hit[same]] = first[k[same]], count[k[same]]
        new = np.flatnonzero(at < 0)
        old = np.flatnonzero(at >= 0)
        flat: list[int] = []
        ends = []
        for ids in encode(new) if len(new) else ():
            flat += ids
            ends.append(len(flat))
        fresh = np.array(flat, self.dtype)
        n[new] = np.diff(ends, prepend=0)
        bounds = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(bounds[-1], self.dtype)
        for which, pool, begin in ((old, self.ids, at[old]), (new, fresh, np.cumsum(n[new]) - n[new])):
            m = n[which]
            step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            out[np.repeat(bounds[which], m) + step] = pool[np.repeat(begin, m) + step]
        keep = (e - s)[new] <= 64
        if keep.any():
            self._add(data, s[new], e[new], h[new], fresh, n[new], keep)
        return out, n

    def _add(self, data, s, e, h, ids, n, keep) -> None:
        first = self.ids_used + np.cumsum(n) - n
        self.ids, self.ids_used = _appended(self.ids, self.ids_used, ids, 0)
        s, e, h, n, first = (x[keep] for x in (s, e, h, n, first))
        size = e - s
        place = self.raw_used + np.cumsum(size) - size
        held = data[np.repeat(s - (place - self.raw_used), size) + np.arange(size.sum())]
        self.raw, self.raw_used = _appended(self.raw, self.raw_used, held, 8)
        self._merge(1, (h, place.astype(np.uint32), size.astype(np.uint8), first.astype(np.uint32), n.astype(np.uint8)))
        if 4 * len(self.levels[1][0]) > len(self.levels[0][0]):
            self._merge(0, self.levels[1])
            self.levels[1] = tuple(x[:0] for x in self.levels[1])

    def _merge(self, level: int, more: tuple) -> None:
        both = [np.concatenate(x) for x in zip(self.levels[level], more)]
        order = np.argsort(both[0], kind="stable")
        self.levels[level] = tuple(x[order] for x in both)


def _appended(pool: np.ndarray, used: int, more: np.ndarray, slack: int) -> tuple[np.ndarray, int]:
    if used + len(more) + slack > len(pool):
        grown = np.zeros((used + len(more) + slack) * 5 // 4, pool.dtype)
        grown[:used] = pool[:used]
        pool = grown
    pool[used : used + len(more)] = more
    return pool, used + len(more)


def gather(flat: np.ndarray, size: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of many pieces one after another, bounds), out of the ids of the different ones."""
    n = size[back]
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = (np.cumsum(size) - size)[back]
    return flat[np.repeat(at - bounds[:-1], n) + np.arange(bounds[-1])], bounds


# ---------------------------------------------------------------- words

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the index of its first word (n + 1 of them)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n + 1, bool)
    before[0], before[1:] = False, inside
    after = np.empty(n + 1, bool)
    after[-1], after[:-1] = False, inside
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def run_sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of flags over consecutive ranges given by n + 1 bounds."""
    out = np.zeros(len(bounds) - 1, np.int64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(flags[bounds[0] : bounds[-1]], bounds[full] - bounds[0], dtype=np.int64)
    return out


def text_pieces(data: np.ndarray, limit: int = 4 << 20):
    """Ranges of a text's bytes of about ``limit``, cut before separators so that no word is split."""
    a = 0
    while a < len(data):
        b = min(a + limit, len(data))
        step = 1 << 16
        while b < len(data):
            at = np.flatnonzero(SEPARATOR[data[b : b + step]])
            if len(at):
                b += int(at[0])
                break
            b = min(b + step, len(data))
        yield a, b
        a = b


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, index of each text's first word, n + 1 of them); a long text is read piece by piece."""
    if len(offsets) != 2 or len(data) <= 8 << 20:
        s, e, first = words(data, offsets)
        return range_hashes(data, s, e), first
    parts = []
    for a, b in text_pieces(data):
        s, e, _ = words(data[a:b], np.array([0, b - a]))
        parts.append(range_hashes(data[a:b], s, e))
    out = np.concatenate(parts)
    return out, np.array([0, len(out)])


def owner(bounds: np.ndarray) -> np.ndarray:
    """The range of every element, for n + 1 bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def small_or_salted_join(big: DataFrame, small: DataFrame, key: str, n_small: int, salts: int = 64, limit: int = 50_000) -> DataFrame:
    """``big`` left join ``small`` on one null-safe key: broadcast for at most ``limit`` rows (counted), else salted."""
    side = small.withColumnRenamed(key, "__k")
    if n_small <= limit:
        return big.join(F.broadcast(side), F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")
    side = side.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    big = big.withColumn("__t", F.pmod(F.xxhash64(*[c for c in big.columns]), F.lit(salts)).cast("int"))
    return big.join(side, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__t") == F.col("__s")), "left").drop("__k", "__s", "__t")
