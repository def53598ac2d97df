"""N-gram Jaccard join by T-occurrence search (DivideSkip).

1. Documents become sets of hashed shingles; equal sets become one class.
2. Search space. A linked pair differs in at most d shingles, d known from the sizes. The hash range of shingles is cut
   into more than d segments, so a pair has equal contents in some of them (pigeonhole, exact). Classes that share a
   segment's content are joined, copies inside a task first, and their components are the clusters: no link leaves one.
   Segments of under ``THIN`` shingles are left out where a pair must share another one as well.
3. Search. A cluster's sets are indexed by inverted lists, its classes in order of size. For a class of n shingles and T,
   the overlap that any partner of its size or less must reach, its lists are divided: the L longest are set aside, L
   by least cost, the short ones merged (a heap; many entries are counted at once), classes found T - L times are looked
   up in the long lists, and those that reach the overlap of their own sizes are linked. Lists that hold a
   ``WIDE``-th of the classes are bitmaps, so all candidates of a class are looked up together; where even the merge
   would be dearer than that, as among texts of one template, all lists are set aside. Classes that are
   connected already are skipped before the merge, since only reachability is asked for.
4. Clusters of more than ``CLUSTER`` classes or ``SHINGLES`` shingles are searched in parts that share some classes. Classes
   that end up outside the largest component then meet the whole cluster: few of them go with every part; of many, all
   pairs of up to ``BLOCKS`` blocks are searched. In still larger clusters the
   short lists are dealt to tasks: partners share one of a set's rarest n - T + 1 shingles, by counts over the cluster.
   A list that is still large is searched by pairs of blocks, or all such lists of a cluster at once where this takes
   fewer copies. All of this is exact.

Defined cases: null or wordless texts have empty sets and stand alone; texts of fewer words than a shingle have
their whole sequence as one; repeated rows are of one class; rows of one id and different texts are told apart by a
hash of both; a null id counts as larger than any and is reported as null; a likeness equal to the threshold links; a
very long text is read piece by piece, its hashes are held whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .chosenpath import Union, components, keyed, shingle_sets
from .repeats import LAST, release

LIKE = 90
BAND = 1.25
SPARE = 3
THIN = 3
CLUSTER = 4000
SHINGLES = 1_500_000
BLOCKS = 64
SHARED = 8
PROBE = 80
WIDE = 32
HEAP = 64


# ---------------------------------------------------------------- sets and classes


def set_names(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of every set."""
    n = np.diff(bounds)
    at = np.arange(len(value), dtype=np.uint64) - np.repeat(bounds[:-1], n).astype(np.uint64)
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(C.mix(value + C.mix(at + np.uint64(1))), out=total[1:])
    one = C.mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(np.uint64))
    np.cumsum(C.fold(value, at), out=total[1:])
    return one, total[bounds[1:]] - total[bounds[:-1]]


def _sets(batch, k: int):
    """(first and last row, sorted shingles, bounds) of a batch's texts, slice by slice."""
    data, offsets = C.text_bytes(batch.column("text"))
    for i, j in C.slices(offsets):
        yield i, j, *shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)


def _describe(k: int):
    def run(batches):
        for b in batches:
            for i, j, value, bounds in _sets(b, k):
                one, two = set_names(value, bounds)
                own = [b.column(c).slice(i, j - i) for c in ("doc", "doc_id", "key")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(np.diff(bounds))], ["doc", "doc_id", "key", "name", "alt", "n"])

    return run


def classes(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(documents with their class, classes with their least document), staged. A class's name is its set's; where sets of one name differ, that of both names."""
    seen = C.staged(keyed(docs).mapInArrow(C.released(_describe(k)), "doc long, doc_id long, key long, name long, alt long, n long"))

    def sets_of(rows: DataFrame) -> DataFrame:
        by = rows.where("n > 0").groupBy("set_id", "name")
        return C.staged(by.agg(F.min(F.struct("doc", "key")).alias("rep"), F.min("n").alias("n"), F.min("alt").alias("a0"), F.max("alt").alias("a1")))

    sets = sets_of(seen.withColumn("set_id", F.col("name")))
    clash = C.staged(sets.where("a0 <> a1").select("name", F.lit(True).alias("clash")))
    n = clash.count()
    if n:
        parted = C.small_or_salted_join(seen, clash, "name", n)
        seen = C.staged(parted.withColumn("set_id", F.when(F.col("clash"), F.xxhash64("name", "alt")).otherwise(F.col("name"))).drop("clash"))
        sets = sets_of(seen)
    else:
        seen = seen.withColumn("set_id", F.col("name"))
    return seen.select("doc", "doc_id", "key", "set_id", "n"), sets.select("set_id", "name", "rep.doc", "rep.key", "n")


# ---------------------------------------------------------------- search space


def bands(n: np.ndarray, like: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, band, segments needed) of sets of n shingles: the band of its size, and the one below where a partner may lie in it."""
    band = np.floor(np.log(np.maximum(n, 1)) / np.log(BAND) + 1e-9).astype(np.int64)
    low = np.floor(np.log(np.maximum(n * like / 100, 1)) / np.log(BAND) - 1e-9).astype(np.int64)
    row = np.arange(len(n))
    more = [(row, band)] + [(np.flatnonzero(low <= band - s), None) for s in range(1, int((band - low).max(initial=0)) + 1)]
    rows = np.concatenate([r for r, _ in more])
    at = np.concatenate([band] + [band[r] - s for s, (r, _) in enumerate(more[1:], 1)])
    top = np.ceil(BAND ** (at + 1) + 1e-6)  # the smaller set has fewer shingles
    # |x| + |y| - 2 |x and y| <= (100 - like) / (100 + like) (|x| + |y|), |y| <= 100 |x| / like
    differ = np.floor((100 - like) / (100 + like) * (top + top * 100 / like) + 1e-9).astype(np.int64)
    return rows, at, differ + 1


def segment_names(value: np.ndarray, bounds: np.ndarray, like: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, name) of the segments in which a linked pair of sets must meet."""
    size = np.diff(bounds)
    rows, band, need = bands(size, like)
    full = size[rows] > 0
    rows, band, need = rows[full], band[full], need[full]
    n = need + SPARE * (need > SPARE)  # segments; a pair shares n - need + 1 of them
    out = []
    for i in np.unique(np.stack([band, n, need]), axis=1).T.tolist():
        b, cuts, least = i
        own = rows[band == b]
        length = size[own]
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(bounds[own], length)
        v = C.mix(value[at] ^ np.uint64(0x5BD1E995))
        seg = ((v >> np.uint64(32)) * np.uint64(cuts) >> np.uint64(32)).astype(np.int64)
        code = np.repeat(np.arange(len(own)), length) * cuts + seg
        total = np.zeros(len(own) * cuts, np.uint64)
        np.add.at(total, code, C.mix(v))
        many = np.bincount(code, minlength=len(own) * cuts)
        thin = many < THIN
        few = thin.reshape(-1, cuts).sum(1)
        keep = ~thin | np.repeat(few > cuts - least, cuts)
        place = np.flatnonzero(keep)
        salt = np.uint64(C.mix_int(b + 1)) + (place % cuts).astype(np.uint64)
        out.append((own[place // cuts], C.mix(total[place] + C.mix(salt) + many[place].astype(np.uint64))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _meet(k: int, like: int):
    """(segment, class): of classes that share a segment in a batch only the first is told; the others' edges to it have no segment."""

    def run(batches):
        for b in batches:
            segs, names = [], []
            for _, _, value, bounds in _sets(b, k):
                name = set_names(value, bounds)[0]
                row, seg = segment_names(value, bounds, like)
                segs.append(seg)
                names.append(name[row])
            seg, name = np.concatenate(segs or [np.zeros(0, np.uint64)]), np.concatenate(names or [np.zeros(0, np.uint64)])
            seg, first, back = np.unique(seg, return_index=True, return_inverse=True)
            lead = name[first]
            far = np.flatnonzero(lead[back] != name)
            edge = np.unique(np.stack([name[far], lead[back][far]]), axis=1) if len(far) else np.zeros((2, 0), np.uint64)
            v = pa.array(np.concatenate([lead, edge[1]]).view(np.int64))
            u = pa.array(np.concatenate([seg, edge[0]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([True, False], [len(seg), edge.shape[1]])), u, v], ["told", "u", "v"])

    return run


def _stars(batches):
    """Edges of the classes of each segment to its first; rows come sorted by segment."""
    at = lead = None
    for b in batches:
        seg, name = np.asarray(b.column("seg")), np.asarray(b.column("v"))
        if not len(seg):
            continue
        new = np.ones(len(seg), bool)
        new[1:] = seg[1:] != seg[:-1]
        new[0] = at is None or seg[0] != at
        start = np.maximum.accumulate(np.where(new, np.arange(len(seg)), -1))
        first = np.where(start < 0, lead if lead is not None else 0, name[np.maximum(start, 0)])
        at, lead = seg[-1], first[-1]
        far = np.flatnonzero(first != name)
        if len(far):
            e = np.unique(np.stack([name[far], first[far]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(e[0]), pa.array(e[1])], ["u", "v"])


def clusters(docs: DataFrame, k: int, like: int = LIKE) -> DataFrame:
    """(u, root): the cluster of every class that may have a partner, by its set's name."""
    told = C.staged(keyed(docs).mapInArrow(C.released(_meet(k, like)), "told boolean, u long, v long"))
    by = told.where("told").select(F.col("u").alias("seg"), "v").repartition("seg").sortWithinPartitions("seg")
    edges = by.mapInArrow(_stars, "u long, v long").unionByName(told.where("not told").select("u", "v"))
    label = components(edges.distinct())
    C.drop_stage(told)
    release(docs.sparkSession)
    return label


# ---------------------------------------------------------------- search


class Lists:
    """Inverted lists of some sets: for each shingle the places of the sets that hold it, ascending."""

    def __init__(self, value: np.ndarray, bounds: np.ndarray):
        self.m = len(bounds) - 1
        own = C.owner(bounds)
        shingle, self.of = np.unique(value, return_inverse=True)
        code = np.sort(self.of.astype(np.int64) * self.m + own)  # all lists, one after another
        self.code = code
        n = np.bincount(self.of, minlength=len(shingle))
        wide = np.flatnonzero((n > 1) & (n * WIDE >= self.m))
        self.column = np.full(len(shingle), -1)
        self.column[wide] = np.arange(len(wide))
        self.bits = np.zeros((self.m, -(-len(wide) // 64)), np.uint64)
        at = self.column[self.of]
        own, at = own[at >= 0], at[at >= 0]
        np.bitwise_or.at(self.bits, (own, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))

    def spans(self, shingles: np.ndarray, low: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of some shingles hold places from ``low`` to before ``q``: begins and ends."""
        return np.searchsorted(self.code, shingles * self.m + low), np.searchsorted(self.code, shingles * self.m + q)

    def lists(self, a: np.ndarray, b: np.ndarray, skip: np.ndarray) -> list[np.ndarray]:
        """The places of some spans, without those to be skipped; empty lists are left out."""
        n = b - a
        x = self.code[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())] % self.m
        keep = ~skip[x]
        own = np.repeat(np.arange(len(n)), n)[keep]
        return [p for p in np.split(x[keep], np.flatnonzero(np.diff(own)) + 1) if len(p)]

    def held(self, shingles: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How many of the lists of some shingles hold each of some places (ascending): by bitmaps; the others by binary search, or read where they are short."""
        at = self.column[shingles]
        narrow, at = shingles[at < 0], at[at >= 0]
        mask = np.zeros(self.bits.shape[1], np.uint64)
        np.bitwise_or.at(mask, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
        words = np.flatnonzero(mask)
        own = self.bits[places] if len(words) == len(mask) else self.bits[places[:, None], words]
        out = np.bitwise_count(own & mask[words]).sum(1, dtype=np.int64)
        if len(narrow) and len(places):
            a, b = self.spans(narrow, places[0], places[-1] + 1)
            n = b - a
            if n.sum() <= len(narrow) * len(places):
                x = self.code[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())] % self.m
                out += np.bincount(x - places[0], minlength=places[-1] + 1 - places[0])[places - places[0]]
            else:
                want = narrow[:, None] * self.m + places
                out += (self.code[np.minimum(np.searchsorted(self.code, want), len(self.code) - 1)] == want).sum(0)
        return out


def divided(sizes: np.ndarray, overlap: int, probe: int = PROBE) -> int:
    """How many of the longest lists to set aside; sizes ascend.

    DivideSkip's trade-off, from the lists' own sizes: with L set aside, the others have S(L) entries to merge and at
    most S(L) / (T - L) candidates to look up, each as dear as ``probe`` entries.
    """
    aside = np.arange(min(overlap, len(sizes) + 1))
    merged = np.concatenate([[0], np.cumsum(sizes)])[len(sizes) - aside]
    return int(np.argmin(merged * (1 + probe / (overlap - aside))[: len(aside)]))


def occurrences(lists: list[np.ndarray]) -> list[tuple[int, int]]:
    """(place, number of lists that hold it), by a heap over the lists' heads."""
    heap = [(int(x[0]), i, 0) for i, x in enumerate(lists) if len(x)]
    heapq.heapify(heap)
    out = []
    while heap:
        place, count = heap[0][0], 0
        while heap and heap[0][0] == place:
            _, i, at = heap[0]
            count += 1
            if at + 1 < len(lists[i]):
                heapq.heapreplace(heap, (int(lists[i][at + 1]), i, at + 1))
            else:
                heapq.heappop(heap)
        out.append((place, count))
    return out


def merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``occurrences`` as arrays; many entries are counted at once."""
    if sum(map(len, lists)) > HEAP:
        return np.unique(np.concatenate(lists), return_counts=True)
    found = np.array(occurrences(lists), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def joined(value: np.ndarray, bounds: np.ndarray, like: int, fresh: np.ndarray) -> Union:
    """The sets, ascending in size, with linked ones connected; those that aren't fresh are connected to begin with."""
    n = np.diff(bounds)
    index, u = Lists(value, bounds), Union(len(n))
    old = np.flatnonzero(~fresh).tolist()
    for i in old[1:]:
        u.join(i, old[0])
    known = np.array([u.find(i) for i in range(len(n))])

    hits = np.zeros(len(n), np.int64)
    for q in range(1, len(n)):
        overlap = max(1, -(-int(n[q]) * like // 100))
        low = int(np.searchsorted(n, overlap))
        if low >= q:
            continue
        mine = index.of[bounds[q] : bounds[q + 1]].astype(np.int64)

        def connect(places: np.ndarray, count, left: np.ndarray) -> None:
            """Those of some places, of ``count`` common shingles and those of the lists ``left``, that are linked with q are connected."""
            both = count + index.held(left, places)
            near = places[100 * both >= like * (n[q] + n[places] - both)]
            if len(near):
                hits[near] += 1
                same = np.unique(np.append(known[near], known[q]))
                known[np.isin(known, same)] = same[0]

        # the set that most others hang on, and the one before, are tried first: their components need no search then
        first = np.unique([low + int(hits[low:q].argmax()), q - 1])
        first = first[known[first] != known[q]]
        if len(first):
            connect(first, 0, mine)
        skip = known == known[q]
        if skip[low:q].all():
            continue
        a, b = index.spans(mine, low, q)
        order = np.argsort(b - a, kind="stable")
        aside = divided((b - a)[order], overlap)
        short, long = order[: len(order) - aside], mine[order[len(order) - aside :]]
        if (b - a)[short].sum() >= q - low:
            connect(low + np.flatnonzero(~skip[low:q]), 0, mine)
            continue
        places, count = merged(index.lists(a[short], b[short], skip))
        keep = count >= overlap - aside
        if keep.any():
            connect(places[keep], count[keep], long)
    for i, c in enumerate(known.tolist()):
        u.join(i, c)
    return u


def _search(k: int, like: int):
    """(u, v): each class of a part with the first of its component there. Rows come sorted by root and part."""

    def links(rows):
        ids, first = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True)
        text = [(rows[i][1] or "").encode() for i in first]
        value, bounds = shingle_sets(np.frombuffer(b"".join(text), np.uint8), np.cumsum([0, *map(len, text)]), k)
        fresh = np.zeros(len(ids), bool)
        back = np.searchsorted(ids, [r[0] for r in rows])
        np.logical_or.at(fresh, back, np.array([r[2] for r in rows], bool))
        order = np.lexsort((ids, np.diff(bounds)))
        n = np.diff(bounds)[order]
        at = np.concatenate([[0], np.cumsum(n)])
        value = value[np.repeat(bounds[:-1][order] - at[:-1], n) + np.arange(at[-1])]
        ids = ids[order]
        u = joined(value, at, like, fresh[order])
        return pa.RecordBatch.from_pydict({"u": ids, "v": ids[[u.find(x) for x in range(len(ids))]]})

    def run(batches):
        at, held = None, []
        for b in batches:
            for root, part, *x in zip(*(c.to_pylist() for c in b.columns)):
                if (root, part) != at:
                    if len(held) > 1:
                        yield links(held)
                    at, held = (root, part), []
                held.append(x)
        if len(held) > 1:
            yield links(held)

    return run


CLASS = ["set_id", "doc", "key", "root", "part", "fresh"]


def _searched(dealt: DataFrame, texts: DataFrame, k: int, like: int) -> DataFrame:
    rows = texts.join(dealt.select(CLASS).hint("merge"), ["doc", "key"]).repartition("root", "part").sortWithinPartitions("root", "part", "set_id")
    return rows.select("root", "part", "set_id", "text", "fresh").mapInArrow(C.released(_search(k, like)), "u long, v long").where("u <> v")


def _dealt(rows: DataFrame, parts, share, key: str = "root") -> DataFrame:
    """``rows`` in ``parts`` parts a group; those that ``share`` holds for go to every part."""
    rows = rows.withColumn("p", parts.cast("int")).withColumn("share", share)
    own = rows.where("not share").withColumn("part", F.pmod(F.xxhash64("set_id", key), F.col("p")).cast("int"))
    return own.unionByName(rows.where("share").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("p") - 1))))


def links(docs: DataFrame, k: int, like: int = LIKE, cluster: int = CLUSTER, shingles: int = SHINGLES, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with class, classes, edges (u, v) between linked or connected classes)."""
    spark = docs.sparkSession
    seen, sets = classes(docs, k)
    release(spark)
    label = clusters(docs, k, like).withColumnRenamed("u", "name")
    wanted = sets.join(label, "name").select("set_id", "doc", "key", "n", "root")
    size = wanted.groupBy("root").agg(F.count("*").alias("m"), F.sum("n").alias("w")).where("m > 1")
    parts = F.least(F.col("m"), F.ceil(F.greatest(F.col("m") / F.lit(cluster), F.col("w") / F.lit(shingles))))
    placed = C.staged(wanted.join(size.withColumn("p", parts), "root"))
    texts = keyed(docs).select("doc", "key", "text")
    # about SHARED classes of a large cluster, chosen by hash alone, go to all of its parts
    shared = F.pmod(F.xxhash64(F.lit(3), "set_id", "root"), F.lit(1 << 40)) < F.lit(float(1 << 40)) * SHARED / F.col("m")
    dealt = _dealt(placed, F.col("p"), (F.col("p") > 1) & shared).withColumn("fresh", F.lit(True))
    edges = C.staged(_searched(dealt, texts, k, like))
    release(spark)
    large = placed.where("p > 1")
    if large.limit(1).count():
        edges = edges.unionByName(_rest(large, edges, texts, k, like, cluster, blocks))
    return seen, sets, edges


def _block_pairs(rows: DataFrame, b) -> DataFrame:
    """``rows`` in ``b`` blocks a root, all pairs of them parts of their own."""
    i, other = F.pmod(F.xxhash64("set_id", "root"), F.col("b")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("b") - 1))
    rows = rows.withColumn("b", b.cast("int")).withColumn("i", i).withColumn("j", other).where("i <> j or b = 1")
    return rows.withColumn("part", F.least("i", "j") * F.col("b") + F.greatest("i", "j"))


def _rest(large: DataFrame, edges: DataFrame, texts: DataFrame, k: int, like: int, cluster: int, blocks: int) -> DataFrame:
    """In clusters that were searched in parts: classes outside the largest component against all others."""
    own = components(edges).withColumnsRenamed({"u": "set_id", "root": "comp"})
    comp = C.staged(large.select("set_id", "root", "doc", "key", "n", "m", (2 * F.col("p")).alias("b")).join(own, "set_id", "left").withColumn("comp", F.coalesce("comp", "set_id")))
    count = comp.groupBy("root", "comp").agg(F.count("*").alias("c"))
    main = count.groupBy("root").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), (F.sum("c") - F.max("c")).alias("out"))
    half = max(1, cluster // 2)
    tagged = comp.join(main.where("out > 0"), "root").withColumn("fresh", F.col("comp") != F.col("main"))
    tagged = C.staged(tagged.select("set_id", "root", "doc", "key", "n", "m", "b", "out", "fresh"))
    # b blocks, half a part each: those outside go with every block, or every two blocks meet
    few = _dealt(tagged.where("out * b <= m"), F.col("b"), F.col("fresh")).select(CLASS)
    paired = _block_pairs(tagged.where(F.col("out") * F.col("b") > F.col("m")).where(F.col("b") <= blocks), F.col("b")).select(CLASS)
    edges = C.staged(_searched(few.unionByName(paired), texts, k, like))
    many = tagged.where(F.col("out") * F.col("b") > F.col("m")).where(F.col("b") > blocks).drop("b")
    if not many.limit(1).count():
        return edges
    # short lists: the rarest shingles of every class, by their counts in the cluster
    rows = texts.join(many.select("doc", "key", "set_id", "root", "n"), ["doc", "key"])
    held = C.staged(rows.select("set_id", "root", "n", "text").mapInArrow(C.released(_shingled(k)), "set_id long, root long, n long, shingle long"))
    often = held.groupBy("root", "shingle").agg(F.count("*").alias("df")).where("df > 1")
    held = held.join(often, ["root", "shingle"])
    own = Window.partitionBy("set_id", "root")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "shingle"))  # shingles of one class alone come first
    near = held.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * like / 100) + 1)
    near = near.select("set_id", "root", F.xxhash64("root", "shingle").alias("list")).join(many.select("set_id", "root", "doc", "key", "fresh"), ["set_id", "root"])
    size = near.groupBy("list").agg(F.count("*").alias("m"), F.sum(F.col("fresh").cast("int")).alias("out")).where("m > 1 and out > 0")
    near = C.staged(near.withColumnsRenamed({"root": "home", "list": "root"}).join(size.withColumnRenamed("list", "root"), "root"))
    one = near.where(F.col("m") <= cluster).withColumn("part", F.lit(0)).select(CLASS)
    over = near.where(F.col("m") > cluster)
    with_all = _dealt(over.where(F.col("out") <= half), F.ceil(F.col("m") / F.lit(half)), F.col("fresh")).select(CLASS)
    # lists of which much is outside go by pairs of blocks: each its own, or a cluster's as one group where this takes fewer copies
    b = lambda c: F.ceil(F.col(c) / F.lit(half))
    wide = over.where(F.col("out") > half)
    group = wide.groupBy("home").agg(F.sum(b("m")).alias("copies"), F.count_distinct("set_id").alias("g"))
    wide = wide.join(group.select("home", "g", (F.col("g") * b("g") <= F.col("copies")).alias("whole")), "home")
    own = _block_pairs(wide.where("not whole"), b("m")).select(CLASS)
    whole = wide.where("whole").drop("root").withColumnRenamed("home", "root").dropDuplicates(["root", "set_id"])
    paired = _block_pairs(whole, b("g")).select(CLASS)
    return edges.unionByName(C.staged(_searched(one.unionByName(with_all).unionByName(own).unionByName(paired), texts, k, like)))


def _shingled(k: int):
    def run(batches):
        for b in batches:
            for i, j, value, bounds in _sets(b, k):
                size = np.diff(bounds)
                own = [pa.array(np.repeat(np.asarray(b.column(c))[i:j], size)) for c in ("set_id", "root", "n")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(value.view(np.int64))], ["set_id", "root", "n", "shingle"])

    return run


def linked(docs: DataFrame, k: int = 3, like: int = LIKE, **params) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id of every document: the least document that it reaches by links of ``like`` percent."""
    seen, sets, edges = links(docs, k, like, **params)
    label = components(edges).withColumnRenamed("u", "set_id")
    named = sets.select("set_id", "doc").join(label, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = C.staged(named)
    least = named.groupBy("root").agg(F.min("doc").alias("least"))
    named = C.staged(named.join(least, "root").select("set_id", "least"))
    out = seen.join(named, "set_id", "left")
    least = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("least"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.nullif(least, F.lit(LAST)).alias("component_id"), "set_id")
