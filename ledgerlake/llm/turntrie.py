"""The prefix trie of conversations, out of their globally sorted turn arrays.

A turn is a token: the 128-bit hash of its role and text. A conversation is the array of its tokens, and the arrays,
as bytes, are sorted over the whole cluster by ranges of array and id, so that many equal conversations lie in
several ranges. Then

1. each range is swept once: the common prefix (LCP) with the array before tells which nodes of the open stack end
   and which begin. A node that begins and ends inside the range is finished there. The prefixes of the range's first
   and last array may go on in other ranges; what the range knows of them is written as two open paths.
2. the open paths of all ranges, two rows a range, are swept by the same rule, which stitches the stacks; the tokens
   of these rows are all that one task reads.
3. Nodes below a stitched one learn their parent's id by a join with the stitched nodes.

Ids of conversations that end at a stitched node are written in parts and hashed one part after another, streamed in
order; those of other nodes lie in one range.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), then role, then the hash of role
and text, so repeated rows are turns of their own, side by side; rows without a conversation id take no part; negative
ids are rounded towards 0; a very long text is one token, a very long conversation one array of 24 bytes a turn; an
empty table has no node, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .mixing import word_count
from .repeats import LAST

TOKEN = 16
RANGE = 200_000
IDS = 8_000
NOTHING = hashlib.sha256(b"").hexdigest()


def arrays(turns: DataFrame) -> DataFrame:
    """conv_id, t (its turns in order: token and number of words) of every conversation, staged."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), token.alias("token"), word_count().alias("words"))
    by = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id")
    t = F.transform(F.sort_array(F.collect_list("t")), lambda x: F.struct(x["token"].alias("token"), x["words"].alias("words")))  # a conversation's turns
    return C.staged(by.agg(t.alias("t")))


def branched(convs: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Every conversation with its first h turns replaced by those of the first of its ``family``; h: the id's crc32 modulo ``most``."""
    head = convs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("t", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    both = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(head, "base", "left").withColumn("h", h)
    own = F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0)))
    taken = F.when(F.col("head").isNull(), F.slice("t", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return both.select("conv_id", F.concat(taken, own).alias("t"))


def common(a: bytes, b: bytes) -> int:
    """Tokens that two arrays begin with."""
    low, high = 0, min(len(a), len(b)) // TOKEN
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * TOKEN : mid * TOKEN] == b[low * TOKEN : mid * TOKEN]:
            low = mid
        else:
            high = mid - 1
    return low


def node_id(key: bytes, depth: int) -> bytes:
    return hashlib.md5(key[: depth * TOKEN]).digest()


class Frame:
    """An open node: what its closed children and its own ends add up to."""

    __slots__ = ("children", "convs", "ends", "first", "leaves", "least", "saved", "waiting", "words")

    def __init__(self, words: int, first: bool = False):
        self.words, self.first = words, first
        self.least, self.convs, self.children, self.leaves, self.saved = LAST, 0, 0, 0, 0
        self.ends: list[str] = []
        self.waiting: list[tuple] = []

    def add(self, least: int, convs: int, children: int, leaves: int, saved: int) -> None:
        self.least = min(self.least, least)
        self.convs += convs
        self.children += children
        self.leaves += leaves
        self.saved += saved

    def close(self, depth: int, sha, up: Frame | None) -> tuple:
        """The finished node (conv_id, depth, n_convs, n_children, n_leaves, saved_tokens, sha), told to its parent."""
        leaves = self.leaves or 1
        saved = self.saved + (self.convs - 1) * self.words
        if up:
            up.add(self.least, self.convs, 1, leaves, saved)
        return self.least, depth, self.convs, self.children, leaves, saved, sha

    def known(self) -> tuple:
        return self.least, self.convs, self.children, self.leaves, self.saved, self.words


NODE = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
SWEPT = "kind int, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent_conv_id long, node binary, part int, seq int, ids string, path binary, known array<array<long>>"
_SWEPT = pa.schema([("kind", pa.int32()), *((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string()), ("parent_conv_id", pa.int64()), ("node", pa.binary()), ("part", pa.int32()), ("seq", pa.int32()), ("ids", pa.string()), ("path", pa.binary()), ("known", pa.list_(pa.list_(pa.int64())))])
FINISHED, BELOW, OPEN, ENDS = range(4)


class _Out:
    """Rows on their way out, a batch at a time."""

    def __init__(self):
        self.rows: list[dict] = []

    def node(self, row: tuple, **more) -> None:
        self.rows.append(dict(zip(NODE, row), ends_sha256=row[6], **more))

    def batch(self, least: int = 1):
        if len(self.rows) >= least:
            yield pa.RecordBatch.from_pylist(self.rows, _SWEPT)
            self.rows = []


def _sweep(batches):
    part, out = TaskContext.get().partitionId(), _Out()
    stack: list[Frame] = []
    opened: list[Frame] = []  # the nodes of the first array
    head = last = None

    def hand_on(f: Frame, key: bytes, depth: int) -> None:
        """An open node's children, and its ends, wait for the stitched one."""
        name = node_id(key, depth)
        out.rows += [dict(zip(NODE, w), ends_sha256=w[6], kind=BELOW, node=name) for w in f.waiting]
        f.waiting = []
        out.rows += [{"kind": ENDS, "node": name, "part": part, "seq": k, "ids": ",".join(f.ends[k : k + IDS])} for k in range(0, len(f.ends), IDS)]

    def close(key: bytes) -> None:
        depth, f = len(stack) - 1, stack.pop()
        if f.first:
            hand_on(f, key, depth)
            return
        sha = hashlib.sha256(",".join(f.ends).encode()).hexdigest() if f.ends else NOTHING
        up = stack[-1]
        row = f.close(depth, sha, up)
        up.waiting.append(row)
        for w in f.waiting:
            out.node(w, kind=FINISHED, parent_conv_id=f.least)

    for b in batches:
        for conv_id, key, words in zip(*(b.column(k).to_pylist() for k in ("conv_id", "key", "words"))):
            if last is None:
                head, keep = key, -1
                opened = [Frame(w, True) for w in (0, *words)]
                stack = list(opened)
            else:
                keep = common(last, key)
                while len(stack) - 1 > keep:
                    close(last)
                stack += [Frame(w) for w in words[keep:]]
            f = stack[-1]
            f.ends.append(str(conv_id))
            f.convs += 1
            f.least = min(f.least, conv_id)
            last = key
        yield from out.batch(5_000)
    if last is None:
        return
    # what is still open: the path of the last array, and that of the first; those in both are told with the first
    tail = [(d, f) for d, f in enumerate(stack) if not f.first]
    for d, f in enumerate(stack):
        hand_on(f, last, d)
    out.rows.append({"kind": OPEN, "part": part, "seq": 0, "path": head, "known": [list(f.known()) for f in opened]})
    if tail:
        out.rows.append({"kind": OPEN, "part": part, "seq": 1, "path": last, "known": [list(f.known()) for _, f in tail]})
    yield from out.batch()


STITCHED = "node binary, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_STITCHED = pa.schema([("node", pa.binary()), ("parent_conv_id", pa.int64()), *((c, pa.int64()) for c in NODE)])


def _stitch(batches):
    """Nodes of the open paths, which come in order of range: each path adds what its range knows of its last nodes."""
    stack: list[Frame] = []
    last = b""
    rows: list[dict] = []

    def close() -> None:
        depth, f = len(stack) - 1, stack.pop()
        up = stack[-1] if stack else None
        row = f.close(depth, node_id(last, depth), up)
        for w in f.waiting:
            rows.append(dict(zip(NODE, w), node=w[6], parent_conv_id=f.least))
        if up:
            up.waiting.append(row)
        else:
            rows.append(dict(zip(NODE, row), node=row[6], parent_conv_id=None))

    for b in batches:
        for path, known in zip(*(b.column(k).to_pylist() for k in ("path", "known"))):
            keep = common(last, path) if stack else -1
            while len(stack) - 1 > keep:
                close()
            depth = len(path) // TOKEN
            begin = depth + 1 - len(known)
            while len(stack) <= depth:
                stack.append(Frame(known[len(stack) - begin][5]))
            for f, k in zip(stack[begin:], known):
                f.add(*k[:5])
            last = path
        if len(rows) >= 5_000:
            yield pa.RecordBatch.from_pylist(rows, _STITCHED)
            rows.clear()
    while stack:
        close()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _STITCHED)


def _hash_ends(batches):
    """The hash of each node's ids; parts come in order, and only the running hash is held."""
    at, run, done = None, None, []
    for b in batches:
        for node, ids in zip(*(c.to_pylist() for c in (b.column("node"), b.column("ids")))):
            if node != at:
                if at is not None:
                    done.append((at, run.hexdigest()))
                at, run = node, hashlib.sha256()
            else:
                run.update(b",")
            run.update(ids.encode())
        if len(done) > 5_000:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["node", "ends_sha256"])
            done = []
    if at is not None:
        done.append((at, run.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["node", "ends_sha256"])


def trie(convs: DataFrame, at_most: int = RANGE) -> DataFrame:
    """One row per node of the conversations (conv_id, t): see the query's contract for the columns."""
    convs = C.staged(convs)
    spark = convs.sparkSession
    size = convs.agg(F.sum(F.size("t") + 1)).first()[0] or 0
    ranges = max(spark.sparkContext.defaultParallelism, -(-size // at_most))
    key = F.unhex(F.array_join(F.transform("t", lambda x: x["token"]), ""))
    rows = convs.select("conv_id", key.alias("key"), F.transform("t", lambda x: x["words"]).alias("words"))
    ranged = rows.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    swept = C.staged(ranged.mapInArrow(C.released(_sweep), SWEPT))
    paths = swept.where(F.col("kind") == OPEN).select("part", "seq", "path", "known")
    edge = C.staged(paths.repartition(1).sortWithinPartitions("part", "seq").mapInArrow(_stitch, STITCHED))
    ends = swept.where(F.col("kind") == ENDS).select("node", "part", "seq", "ids")
    ends = ends.repartition("node").sortWithinPartitions("node", "part", "seq").mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    columns = ["conv_id", "depth", "parent_conv_id", *NODE[2:], "ends_sha256"]
    n_edge = edge.count()
    open_ids = edge.select("node", F.col("conv_id").alias("up"))
    below = C.small_or_salted_join(swept.where(F.col("kind") == BELOW).drop("parent_conv_id"), open_ids, "node", n_edge)
    below = below.withColumn("parent_conv_id", F.col("up")).select(columns)
    edge = edge.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(columns)
    return swept.where(F.col("kind") == FINISHED).select(columns).unionByName(below).unionByName(edge)


def conversation_trie(turns: DataFrame, **params) -> DataFrame:
    """``trie`` of the conversations rebuilt by ``branched``."""
    return trie(branched(arrays(turns)), **params)
