"""Windows that occur elsewhere: the frame shared by byte and word substring dedup.

Every window of ``width`` units holds an anchor: its ``gram``-unit substring of least hash (leftmost), a function
of the window alone, so equal windows have their anchor at the same place. Consecutive windows with one anchor
form a run; a text of n units has about 2n / (width - gram) runs. The initial buckets are the anchors.

1. ``runs``: (anchor, content id, document, starts) of all runs. Content ids are 64-bit hashes.
2. Runs of equal content are counted with map-side sums, and one of them (``twins``: two) stands for all, however
   many there are.
3. Of anchors with several runs (``twins``: copies of one run are several) the standing ones are fetched (their text)
   and dealt by anchor to tasks, where ``classes`` (a suffix array or suffix trees) finds the windows that are equal.
   What it finds for a run holds for the other copies of that run.
4. An anchor with more than ``GROUP`` different runs is dealt in salted parts. Each part settles what it can; of
   the rest, blocks of windows are compared by hash over all parts, then windows of blocks that recur.

Documents are keyed by their id and a hash of id and text. No task holds more than a document, or ``GROUP`` runs;
long texts are read in overlapping pieces of ``PIECE`` units. A common anchor is one key of the joins below, whose
other side has one row for it: adaptive execution splits such keys, and map-side sums shrink them before.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

GROUP = 20_000
BLOCK = 8
CHUNK_UNITS = 1 << 20
PIECE = 1 << 20
LAST = (1 << 63) - 1

Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
Classes = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span < width:
        step = min(span, width - span)
        a = np.minimum(a[:-step], a[step:])
        span += step
    return a


def find_runs(values: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """(first window, last window, anchor, content id) of all runs of texts values[bounds[i]:bounds[i+1]]."""
    n = len(values) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    g = C.window_hashes(values, gram)
    low = np.uint64(0xFFFFFFFF)
    p = (sliding_least((g & ~low) | np.arange(len(g), dtype=np.uint64), width - gram + 1) & low).astype(np.int64)
    long = np.diff(bounds) >= width
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, bounds[:-1][long], 1)
    np.add.at(mark, bounds[1:][long] - width + 1, -1)
    valid = np.cumsum(mark[:n]) > 0
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (p[1:] != p[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (p[1:] != p[:-1])
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    # a run is shorter than two windows: its first and last one and the distance tell it whole
    # (the distance goes first: a run of one window would else fold its hash into itself)
    content = C.mix((b - a).astype(np.uint64) + np.uint64(1))
    for end in (a, b):
        content = C.fold(content, C.wide_hashes(g, gram, end, width))
    return a, b, C.mix(g[p[a]]), content


def _runs(units: Units, width: int, gram: int):
    def rows(keys, docs, values, bounds, shift):
        a, b, anchor, content = find_runs(values, bounds, width, gram)
        owner = np.searchsorted(bounds, a, "right") - 1
        own = content ^ C.mix(owner.astype(np.uint64) + np.uint64(1)) ^ anchor
        order = np.argsort(own, kind="stable")
        first = np.flatnonzero(np.diff(own[order], prepend=own[order][:1] + np.uint64(1))) if len(own) else order
        at = order[first]
        starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array((a - bounds[owner] + shift)[order], pa.int64()))
        return pa.RecordBatch.from_pydict({"a": anchor[at].view(np.int64), "r": content[at].view(np.int64), "key": keys[owner[at]], "doc": docs[owner[at]], "starts": starts, "size": (b - a + 1)[at].astype(np.int32)})

    def run(batches):
        for batch in batches:
            data, offsets = C.text_bytes(batch.column("text"))
            keys, docs = np.asarray(batch.column("key")), np.asarray(batch.column("doc"))
            for i, j in C.slices(offsets):
                values, bounds = units(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if len(values) <= PIECE + width:
                    yield rows(keys[i:j], docs[i:j], values, bounds, 0)
                    continue
                for k in range(j - i):  # long texts: overlapping pieces, so that every window lies in one
                    v = values[bounds[k] : bounds[k + 1]]
                    for s in range(0, max(1, len(v) - width + 1), PIECE):
                        part = v[s : s + PIECE + width - 1]
                        yield rows(keys[i + k : i + k + 1], docs[i + k : i + k + 1], part, np.array([0, len(part)]), s)

    return run


def _fetch(units: Units, width: int):
    """The units of wanted runs, from their documents' texts."""

    def run(batches):
        for batch in batches:
            data, offsets = C.text_bytes(batch.column("text"))
            wanted = batch.column("wanted")
            for i in range(batch.num_rows):
                values, _ = units(data[offsets[i] : offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                w = wanted.slice(i, 1).flatten()
                start, size = np.asarray(w.field("start")), np.asarray(w.field("size"))
                cut = [values[s : s + n - 1 + width].tobytes() for s, n in zip(start.tolist(), size.tolist())]
                names = ("a", "r", "salt", "merge", "v", "size", "rep", "d0")
                yield pa.RecordBatch.from_arrays([*(w.field(k) for k in names), pa.array(cut, pa.binary())], [*names, "content"])

    return run


def intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the true stretches."""
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _settle(classes: Classes, dtype, width: int, by_least: bool):
    """Per run the windows found elsewhere; kind 1 rows are blocks of windows that other parts of the anchor must see."""

    def chunk(rows):
        size = np.array([x[5] for x in rows], np.int64)
        values = np.frombuffer(b"".join(x[6] for x in rows), dtype)
        lens = size + width - 1
        begin = np.cumsum(lens) - lens
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())  # all windows
        run = np.repeat(np.arange(len(rows)), size)
        cls = classes(values, begin, at)
        v = np.array([x[4] for x in rows], np.int64)[run]
        n = int(cls.max()) + 1
        if by_least:
            least = np.full(n, LAST)
            np.minimum.at(least, cls, v)
            found, open_, told = least[cls] < v, least[cls] == v, least[cls]
        else:
            count = np.zeros(n, np.int64)
            np.add.at(count, cls, v)
            first = np.zeros(len(cls), bool)
            first[np.unique(cls, return_index=True)[1]] = True
            found = count[cls] >= 2
            open_, told = first, count[cls]
        out = {k: [] for k in ("kind", "a", "r", "lo", "hi", "block", "bh", "wh", "v", "own", "rep", "d0")}

        def add(kind, x, lo, hi, block, bh, wh, v):
            for k, value in zip(out, (kind, x[0], x[1], lo, hi, block, bh, wh, v, x[4], x[8], x[9])):
                out[k].append(value)

        edge = np.append(np.cumsum(size) - size, size.sum())
        for i in np.unique(run[found]).tolist():
            lo, hi = intervals(found[edge[i] : edge[i + 1]])
            add(0, rows[i], lo.tolist(), hi.tolist(), 0, 0, None, None)
        merge = np.array([x[3] for x in rows], bool)
        if merge.any():
            for i in np.flatnonzero(merge).tolist():
                x, s = rows[i], slice(edge[i], edge[i + 1])
                own, told_ = open_[s], told[s]
                v_ = values[begin[i] : begin[i] + lens[i]]
                # blocks stand at fixed distances from the anchor, which all runs of the bucket share
                g = C.window_hashes(v_, x[7])
                wh = C.wide_hashes(g, x[7], np.arange(int(size[i])), width)
                p = int(np.argmin((g[size[i] - 1 : width - x[7] + 1] >> np.uint64(32)))) + int(size[i]) - 1
                dist = p - np.arange(int(size[i]))
                for b in np.unique(dist[own] // BLOCK).tolist():
                    k = np.flatnonzero(own & (dist // BLOCK == b))
                    s1 = p - b * BLOCK  # last window of the whole block
                    bh = int(C.wide_hashes(g, x[7], np.array([s1]), width - BLOCK + 1)[0].view(np.int64))  # what its windows share
                    add(1, x, k.tolist(), [], b, bh, wh[k].view(np.int64).tolist(), told_[k].tolist())
        return pa.RecordBatch.from_pydict(out, _SETTLED)

    def run(batches):
        held, total, at = [], 0, None
        for batch in batches:
            for x in zip(*(c.to_pylist() for c in batch.columns)):
                if total >= CHUNK_UNITS and (x[0], x[2]) != at:
                    yield chunk(held)
                    held, total = [], 0
                held.append(x)
                total += x[5] + width - 1
                at = (x[0], x[2])
        if held:
            yield chunk(held)

    return run


_SETTLED = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("r", pa.int64()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())), ("block", pa.int32()), ("bh", pa.int64()), ("wh", pa.list_(pa.int64())), ("v", pa.list_(pa.int64())), ("own", pa.int64()), ("rep", pa.int32()), ("d0", pa.int64())])
SETTLED = "kind int, a long, r long, lo array<int>, hi array<int>, block int, bh long, wh array<long>, v array<long>, own long, rep int, d0 long"


def release(spark) -> None:
    """Let Spark drop the shuffle files of finished steps."""
    gc.collect()
    spark._jvm.System.gc()


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select("doc_id", text.alias("text"), doc.alias("doc"), F.xxhash64(F.lit(7), doc, text).alias("key"))


def covered(docs: DataFrame, units: Units, classes: Classes, dtype, width: int, gram: int, by_least: bool, twins: bool, group: int = GROUP) -> DataFrame:
    """(doc, key, spans): for each keyed document, the unit ranges that windows found elsewhere cover.

    ``by_least``: only windows that also start in a document of lesser id count; else any other start counts.
    ``twins``: of a repeated run two copies go to ``classes``, which then tells all of the result; else equal runs
    settle by counting, and only runs of anchors that also have a run of one copy go there.
    """
    spark = docs.sparkSession
    docs = keyed(docs)
    runs = C.staged(docs.select("key", "doc", "text").mapInArrow(C.released(_runs(units, width, gram)), "a long, r long, key long, doc long, starts array<long>, size int"))
    at = lambda k: F.struct("doc", "key", F.element_at("starts", k).alias("start"))
    by = runs.groupBy("a", "r").agg(F.sum(F.size("starts")).alias("n"), F.min(at(1)).alias("one"), F.max(at(-1)).alias("two"), F.min("size").alias("size"))
    twin = F.col("two.doc") > F.col("one.doc") if by_least else F.col("n") > 1
    each = C.staged(by.withColumn("twin", twin))
    release(spark)
    # anchors that have something to compare
    buckets = each.groupBy("a").agg(F.count("*").alias("m"), F.max("twin").alias("any_twin"), F.min("n").alias("least"))
    buckets = buckets.where("m > 1 or any_twin" if twins else "m > 1 and least = 1").select("a", "m")
    parts = F.ceil(F.col("m") / F.lit(group))
    found_by = lambda rep: F.col(rep + ".doc") if by_least else F.when(F.col("twin") & F.lit(twins), F.col("n") - 1 if rep == "one" else F.lit(1)).otherwise(F.col("n"))
    stands = lambda rep, k: F.struct(F.col(rep + ".doc").alias("doc"), F.col(rep + ".key").alias("key"), F.struct("a", "r", F.pmod("r", parts).cast("int").alias("salt"), (parts > 1).alias("merge"), found_by(rep).cast("long").alias("v"), "size", F.col(rep + ".start").alias("start"), F.lit(k).alias("rep"), F.col("one.doc").alias("d0")).alias("w"))
    reps = F.when(F.col("twin") & F.lit(twins), F.array(stands("one", 0), stands("two", 1))).otherwise(F.array(stands("one", 0)))
    wanted = each.join(buckets, "a").select(F.explode(reps).alias("x")).select("x.doc", "x.key", "x.w")
    wanted = wanted.groupBy("doc", "key").agg(F.collect_list("w").alias("wanted"))  # at most a document's runs
    fetched = docs.select("doc", "key", "text").join(wanted, ["doc", "key"]).select("text", "wanted").mapInArrow(C.released(_fetch(units, width)), "a long, r long, salt int, merge boolean, v long, size int, rep int, d0 long, content binary")
    dealt = fetched.repartition("a", "salt").sortWithinPartitions("a", "salt", "r", "rep")
    dealt = dealt.select("a", "r", "salt", "merge", "v", "size", "content", F.lit(gram).alias("gram"), "rep", "d0")
    settled = C.staged(dealt.mapInArrow(C.released(_settle(classes, dtype, width, by_least)), SETTLED))
    release(spark)
    found = settled.where("kind = 0").select("a", "r", "rep", "d0", "own", F.arrays_zip("lo", "hi").alias("part"))
    # buckets dealt in parts: blocks, then windows, that recur in several parts
    blocks = settled.where("kind = 1")
    again = blocks.groupBy("a", "block", "bh").agg(F.count("*").alias("n")).where("n > 1").select("a", "block", "bh")
    near = blocks.join(again, ["a", "block", "bh"], "left_semi")
    one = near.select("a", "r", "rep", "d0", "own", F.explode(F.arrays_zip("lo", "wh", "v")).alias("x")).select("a", "r", "rep", "d0", "own", F.col("x.lo").alias("lo"), F.col("x.wh").alias("wh"), F.col("x.v").alias("v"))
    whole = one.groupBy("a", "wh").agg(F.min("v").alias("t") if by_least else F.sum("v").alias("t"), F.count("*").alias("c")).where("c > 1").select("a", "wh", "t")
    more = one.join(whole, ["a", "wh"]).where(F.col("t") < F.col("own") if by_least else F.col("t") > 1)
    more = more.groupBy("a", "r", "rep", "d0", "own").agg(F.collect_list(F.struct(F.col("lo").alias("lo"), (F.col("lo") + 1).alias("hi"))).alias("part"))
    part = found.unionByName(more)
    if by_least:  # the least document's run loses what lesser ones hold; its later copies are told by the last of them
        applies = F.when(F.col("rep") == 0, F.col("doc") == F.col("d0")).otherwise(F.col("doc") > F.col("d0"))
    elif twins:
        part, applies = part.where("rep = 0"), F.lit(True)
    else:  # runs of several copies are repeated whole
        full = each.where("n > 1").select("a", "r", F.lit(0).alias("rep"), F.lit(0).cast("long").alias("d0"), F.col("n").alias("own"), F.array(F.struct(F.lit(0).alias("lo"), F.col("size").alias("hi"))).alias("part"))
        part, applies = part.where("own = 1").unionByName(full), F.lit(True)
    hits = runs.join(part.drop("own"), ["a", "r"]).where(applies)
    spans = hits.select("doc", "key", F.explode("starts").alias("s"), "part").select("doc", "key", F.transform("part", lambda x: F.struct((F.col("s") + x["lo"]).alias("from"), (F.col("s") + x["hi"] - 1 + width).alias("to"))).alias("t"))
    out = C.staged(spans.groupBy("doc", "key").agg(F.flatten(F.collect_list("t")).alias("spans")))  # at most a document's runs
    C.drop_stage(settled)
    C.drop_stage(runs)
    C.drop_stage(each)
    release(spark)
    return out


def flags(spans, n: int) -> np.ndarray:
    """Marks of n units that (from, to) spans cover."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, spans[0], 1)
    np.add.at(d, spans[1], -1)
    return np.cumsum(d[:n]) > 0


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Keyed documents with their spans (null: none)."""
    return keyed(docs).select("doc_id", "text", "doc", "key").join(spans, ["doc", "key"], "left").select("doc_id", "text", "spans")


def span_columns(batch) -> list[tuple[np.ndarray, np.ndarray] | None]:
    column, out = batch.column("spans"), []
    for i in range(batch.num_rows):
        w = column.slice(i, 1).flatten()
        out.append((np.asarray(w.field("from")).astype(np.int64), np.asarray(w.field("to")).astype(np.int64)) if len(w) else None)
    return out
