"""Token ids in a compressed binary file: static range asymmetric numeral system over one shared frequency table.

Texts are tokenized with the ``tokenizers`` library. A text is cut where every byte-level pre-tokenizer of
this family cuts (before a lone ASCII white space between two other characters), equal pieces of a slice are
encoded once, told apart by their bytes, and a worker remembers a bounded number of them.

The file is a Parquet folder whose rows are blocks in ascending document order, plus a header row with the
shared table. A block holds whole documents, about ``BLOCK`` ids, coded by ``LANES`` interleaved states;
each has its own lengths, lane states, checkpoints (states and stream position every ``CHECKPOINT`` steps, so
that parts of a block decode on their own) and CRC-32 checksums of its stream and of its ids. Blocks are
independent: any executor decodes any block, and a lost one is coded again from the staged ids.

Defined cases: null is empty and holds only the end id; equal ids of documents stand in text order; null
document ids come last; an empty table writes no block; further columns are ignored; a text holding a special
token's string is encoded as the library does; repeated rows stand next to each other; a very long text is encoded as
a slice of its own and stands in one block.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

END_ID = 0
BLOCK = 1 << 18
LANES = 1024
CHECKPOINT = 128
BITS = 18
SLICE = 2 << 20
PART_BYTES = 128 << 20
SHARDS = 1_000_000
MAGIC = b"RANS1\0\0\0"

_LONE = np.zeros(256, bool)
_LONE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BLUR = _LONE.copy()  # bytes next to which no cut is made: white space, separators, and lead bytes of non-ASCII white space
_BLUR[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_KIND = np.full(256, 8, np.uint8)  # 1: ASCII letters, 2: ASCII punctuation without the apostrophe
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_CACHED: dict[str, Encoder] = {}


class Encoder:
    """A tokenizer and the pieces that a worker remembers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.special = [t["content"].encode() for t in made.get("added_tokens", ())]
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        pre = made.get("pre_tokenizer") or {}
        # a word of letters alone is one pre-token here, so that the library's model takes it directly
        self.direct = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not made.get("normalizer") and not made.get("post_processor")
        self.model = self.tokenizer.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
        self.known = C.Remembered(self.width)

    def encode(self, raw: bytes) -> list[int]:
        text = raw.decode()
        if self.direct and (text[1:] if text[0] == " " else text).isalpha():
            return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.alphabet))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- tokenizing


def pieces(data: np.ndarray, offsets: np.ndarray, at_marks: bool = True) -> np.ndarray:
    """Starts of the pieces that are encoded on their own; ``at_marks``: also between ASCII letters and punctuation other than apostrophes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    blur = _BLUR[data]
    wide = np.zeros(n, bool)  # the character before ends here and may be non-ASCII white space
    wide[1:] |= data[:-1] == 0xC2
    wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
    cut = np.zeros(n, bool)
    cut[1:-1] = _LONE[data[1:-1]] & ~(blur | wide)[:-2] & ~blur[2:]
    if at_marks:
        kind = _KIND[data]
        cut[1:] |= (kind[1:] + kind[:-1]) == 3
    ends = offsets[1:-1]
    cut[ends[ends < n] - 1] = False  # the white space at a text's end has no character after it
    starts = offsets[:-1]
    cut[starts[starts < n]] = True
    return np.flatnonzero(cut)


def encode_slice(data: np.ndarray, offsets: np.ndarray, own: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each)."""
    raw = data.tobytes()
    s = pieces(data, offsets, not any(x in raw for x in own.special))
    if len(s) == 0:
        return np.zeros(0, own.width), np.zeros(len(offsets) - 1, np.int64)
    e = np.append(s[1:], len(data))
    different, back = C.distinct_ranges(data, s, e)
    s_, e_ = s[different], e[different]
    ids, n = own.known.look_up(data, s_, e_, lambda new: (own.encode(raw[a:b]) for a, b in zip(s_[new].tolist(), e_[new].tolist())))
    ids, bounds = C.gather(ids, n, back)
    return ids, np.diff(bounds[np.searchsorted(s, offsets)])


def _tokenize(path: str):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _CACHED:
            _CACHED[path] = Encoder(path)
        own = _CACHED[path]
        for b in batches:
            data, offsets = C.text_bytes(b.column("text"))
            for i, j in C.slices(offsets, SLICE):
                ids, n = encode_slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], own)
                ends = np.cumsum(n)
                rows = [np.append(ids[e - k : e], ids.dtype.type(END_ID)).tobytes() for e, k in zip(ends, n)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(rows, pa.binary()), pa.array([own.width[1:]] * (j - i))], ["doc_id", "ids", "width"])

    return run


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, width): little-endian ids of each text, the end id last; width u2 or u4 by the vocabulary."""
    return docs.select("doc_id", "text").mapInArrow(C.released(_tokenize(path)), "doc_id long, ids binary, width string")


# ---------------------------------------------------------------- the coder


def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every id that occurs."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(len(counts), np.int64)
    f = np.where(counts > 0, np.maximum(1, np.floor(counts.astype(np.float64) * (1 << bits) / total)), 0).astype(np.int64)
    order = np.argsort(-f, kind="stable")
    over, k = int(f.sum()) - (1 << bits), 0
    if over < 0:
        f[order[0]] -= over
    while over > 0:
        cut = min(over, max(int(f[order[k]]) // 2, 0))
        f[order[k]] -= cut
        over, k = over - cut, (k + 1) % len(order)
    return f


class Coder:
    """Encode and decode blocks of ids with one static table."""

    def __init__(self, freq: np.ndarray, bits: int, lanes: int = LANES, checkpoint: int = CHECKPOINT):
        self.bits, self.lanes, self.checkpoint = bits, lanes, checkpoint
        self.freq = freq.astype(np.uint64)
        self.low = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        k, low32, top = np.uint64(self.bits), np.uint64(32), np.uint64(64 - self.bits)
        n, width = len(ids), min(self.lanes, max(len(ids), 1))
        steps = -(-n // width)
        x = np.full(width, 1 << 32, np.uint64)
        stream, marks = [], []
        for t in range(steps - 1, -1, -1):
            s = ids[t * width : (t + 1) * width]
            m = len(s)
            f, y = self.freq[s], x[:m]
            spill = (y >> top) >= f
            stream.append(y[spill].astype(np.uint32))
            y = np.where(spill, y >> low32, y)
            x[:m] = ((y // f) << k) + y % f + self.low[s]
            if t % self.checkpoint == 0:
                marks.append((t, len(stream), x.copy()))
        sizes = [len(a) for a in stream]
        total = sum(sizes)
        words = np.concatenate([*stream[::-1], np.zeros(0, np.uint32)]).tobytes()
        done = np.concatenate([[0], np.cumsum(sizes)])
        head = struct.pack("<8sIIIIII", MAGIC, n, width, self.checkpoint, len(marks), len(words), zlib.crc32(words))
        points = b"".join(struct.pack("<II", t, total - int(done[c])) + states.tobytes() for t, c, states in marks[::-1])
        return head + struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes())) + points + words

    def decode(self, block: bytes, part: int | None = None) -> np.ndarray:
        """All ids, or only those from checkpoint ``part`` to the next."""
        magic, n, width, every, n_marks, n_words, crc = struct.unpack_from("<8sIIIIII", block)
        (ids_crc,) = struct.unpack_from("<I", block, 32)
        size, at = 8 + 8 * width, 36
        words = np.frombuffer(block, np.uint32, n_words // 4, at + n_marks * size)
        if magic != MAGIC or zlib.crc32(words.tobytes()) != crc:
            raise ValueError("damaged block")
        if n == 0:
            return np.zeros(0, np.uint32)
        t0, p = struct.unpack_from("<II", block, at + (part or 0) * size)
        x = np.frombuffer(block, np.uint64, width, at + (part or 0) * size + 8).copy()
        stop = -(-n // width) if part is None else min(t0 + every, -(-n // width))
        mask, k, low32 = np.uint64((1 << self.bits) - 1), np.uint64(self.bits), np.uint64(32)
        out = np.empty(min(stop * width, n) - t0 * width, np.uint32)
        for t in range(t0, stop):
            a = t * width
            m = min(width, n - a)
            y = x[:m]
            slot = y & mask
            s = self.symbol[slot]
            out[a - t0 * width : a - t0 * width + m] = s
            y = self.freq[s] * (y >> k) + slot - self.low[s]
            need = np.flatnonzero(y >> low32 == 0)
            y[need] = (y[need] << low32) | words[p : p + len(need)]
            p += len(need)
            x[:m] = y
        if part is None and zlib.crc32(out.tobytes()) != ids_crc:
            raise ValueError("damaged ids")
        return out


# ---------------------------------------------------------------- writing and reading


def _counts(batches):
    c = np.zeros(0, np.int64)
    for b in batches:
        data, _ = C.text_bytes(b.column("ids"))
        n = np.bincount(data.view("<" + b.column("width")[0].as_py())) if len(data) else np.zeros(0, np.int64)
        if len(n) > len(c):
            c, n = n.astype(np.int64), c
        c[: len(n)] += n
    at = np.flatnonzero(c)
    yield pa.RecordBatch.from_pydict({"id": at.astype(np.int64), "n": c[at]})


def _write_blocks(freq: np.ndarray, bits: int):
    def run(batches):
        from pyspark import TaskContext

        coder, shard = Coder(freq, bits), TaskContext.get().partitionId()
        held, held_n, done, block = [], 0, 0, 0

        def packed():
            ids = np.concatenate([a for _, a in held])
            rows = {"shard": [shard], "block": [block], "before": [done], "n": [len(ids)], "doc_ids": [[d for d, _ in held]], "lengths": [[len(a) for _, a in held]], "data": [coder.encode(ids)]}
            return pa.RecordBatch.from_pydict(rows, _BLOCKS)

        for b in batches:
            for doc_id, raw, width in zip(*(b.column(k).to_pylist() for k in ("doc_id", "ids", "width"))):
                held.append((doc_id, np.frombuffer(raw, "<" + width)))
                held_n += len(held[-1][1])
                if held_n >= BLOCK:
                    yield packed()
                    done, block, held_n = done + held_n, block + 1, 0
                    held.clear()
        if held:
            yield packed()

    return run


_BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])


def write(docs: DataFrame, path: str, tokenizer: str, bits: int = BITS) -> None:
    """Tokenize ``docs`` and write the file (``path``/blocks and ``path``/header) in ascending document order."""
    ids = C.staged(tokenized(docs, tokenizer), keep=False)
    counts = ids.select("ids", "width").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one row an id of the vocabulary
    size = int(counts.id.max()) + 1 if len(counts) else 1
    n = np.zeros(size, np.int64)
    n[counts.id] = counts.n
    bits = max(bits, int(np.ceil(np.log2(size + 1))) + 2)
    freq = scaled(n, bits)
    total = ids.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    cores = ids.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-int(total) // PART_BYTES), min(3 * cores, -(-int(total) // (4 << 20))))
    key = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit("99999999999999999999").cast("decimal(20,0)"))
    keyed = ids.withColumn("key", key)
    ranged = keyed.repartitionByRange(parts, "key", F.substring("ids", 1, 16)) if parts > 1 else keyed.coalesce(1)
    blocks = ranged.sortWithinPartitions("key", "ids").select("doc_id", "ids", "width")
    blocks.mapInArrow(_write_blocks(freq, bits), "shard int, block int, before long, n long, doc_ids array<long>, lengths array<long>, data binary").write.option("compression", "none").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    table = freq.astype("<u4").tobytes()
    spark.createDataFrame([(bits, bytearray(zlib.compress(table)), zlib.crc32(table))], "bits int, freq binary, crc long").coalesce(1).write.parquet(f"{path}/header")
    C.drop_stage(ids)


def _read_blocks(freq: np.ndarray, bits: int, whole: bool):
    def run(batches):
        coder = Coder(freq, bits)
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                ids = coder.decode(r["data"])
                n = np.array(r["lengths"], np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                cut = [raw[4 * (e - k) : 4 * e] for e, k in zip(ends.tolist(), n.tolist())]
                cols = {"doc_id": pa.array(r["doc_ids"], pa.int64()), "start": r["base"] + r["before"] + ends - n, "n_tokens": n, "ids_crc32": np.array([zlib.crc32(c) for c in cut], np.int64)}
                if whole:
                    cols["ids"] = pa.array([c.tobytes() for c in cut], pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    return run


def _table(spark, path: str) -> tuple[np.ndarray, int]:
    head = spark.read.parquet(f"{path}/header").first()
    table = zlib.decompress(bytes(head.freq))
    if zlib.crc32(table) != head.crc:
        raise ValueError("damaged header")
    return np.frombuffer(table, "<u4").astype(np.int64), head.bits


def read(spark, path: str, whole: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids) of every document, decoded from the file."""
    freq, bits = _table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    sums = C.staged(blocks.groupBy("shard").agg(F.sum("n").alias("n")))  # one small row a shard
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(base) if sums.count() <= SHARDS else base, "shard")
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * whole
    return placed.select("before", "base", "doc_ids", "lengths", "data").mapInArrow(C.released(_read_blocks(freq, bits, whole)), out)


def read_part(spark, path: str, shard: int, block: int, part: int) -> np.ndarray:
    """The ids from one checkpoint of a block to the next, decoded without what stands before them."""
    freq, bits = _table(spark, path)
    row = spark.read.parquet(f"{path}/blocks").where((F.col("shard") == shard) & (F.col("block") == block)).select("data").first()
    return Coder(freq, bits).decode(bytes(row.data), part)
