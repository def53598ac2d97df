"""SentencePiece encoding and decoding with a given BPE model, by a forward pass shared over common prefixes.

A text gets a leading mark, spaces become marks, and it is cut before each run of marks and around newlines
(which no piece crosses). The distinct marked words of a slice are sorted, so that they stand in the order of a
trie's depth-first walk; each word keeps the forward states of the prefix it shares with the word before and
goes on from there. The state of a prefix is the last piece of its segmentation: a piece t over w[j:i] closes
prefix i where t is reachable on its own and the pair (last piece of prefix j, t) stays as it is under the
model's merges; a path of such pairs has the Viterbi score 0, any other none, and the model's segmentation is
that single path. Where a prefix has no such piece its merges are simulated. The result is that of the
SentencePiece library; a unigram model's scores play no part, since the public model is a BPE model.

Runs of marks: all merges of marks alone rank below every other, so the marks that no word takes are grouped
from the left by the longest piece of marks.

Words are told apart by their bytes. A very long text is one slice of its own.

Defined cases: null is empty, an empty text has no ids and decodes to an empty text; a mark in a text decodes
to a space; characters outside the vocabulary become byte pieces; repeated rows have equal
ids; ties of merges go to the leftmost, as in the library; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

MARK = "▁"
PAIRS = 300_000
FREE = 1 << 21  # numbers of characters outside the vocabulary follow
SLICE = 2 << 20
_MODELS: dict[str, Model] = {}

OUT = "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


class Model:
    """Pieces, scores and byte pieces of a BPE model, with the bounded pair and word caches of a worker."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        own = [i for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
        self.id_of = {sp.id_to_piece(i): i for i in own}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in own}
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unk = sp.unk_id()
        self.longest = max(map(len, self.id_of))
        self.marks = max((len(p) for p in self.id_of if not p.strip(MARK)), default=1)
        self.raw = [sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        for b, i in self.byte_id.items():
            self.raw[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.raw[i] = b""
        self.piece = {i: sp.id_to_piece(i) for i in own}
        # bounded by the vocabulary: whether a piece's own merges give it (1), don't (2), or nobody asked (0)
        self.reached = bytearray(n)
        self.ends_in: dict[str, int] = {}  # longest piece by its last three characters
        for t in self.id_of:
            if len(t) > 2:
                self.ends_in[t[-3:]] = max(self.ends_in.get(t[-3:], 0), len(t))
        self.pairs: dict[int, bool] = {}
        self.words = C.Remembered(np.uint16 if n <= 1 << 16 else np.uint32)


    def merged(self, w: str) -> list[str]:
        """The model's merges carried out on ``w``: best score first, then leftmost."""
        parts = list(w)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def text(self, k: int) -> str:
        return self.piece[k] if k < FREE else chr(k - FREE)

    def number(self, t: str) -> int:
        """A number for a piece or a single character outside the vocabulary."""
        k = self.id_of.get(t)
        return FREE + ord(t) if k is None else k

    def stays(self, key: int) -> bool:
        """Whether a pair of pieces, numbered ``key``, is what the merges of its text give."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        a, b = self.text(key >> 22), self.text(key & (1 << 22) - 1)
        got = self.pairs[key] = self.merged(a + b) == [a, b]
        return got

    def alone(self, k: int) -> bool:
        if not self.reached[k]:
            self.reached[k] = 1 if self.merged(self.piece[k]) == [self.piece[k]] else 2
        return self.reached[k] == 1

    def forward(self, w: str, last: list[int], shared: int) -> None:
        """Set ``last[i]``, the number of the last piece of w[:i], for i > shared; earlier ones hold already."""
        del last[shared + 1 :]
        known, ends_in, reached, pairs = self.id_of.get, self.ends_in.get, self.reached, self.pairs
        for i in range(shared + 1, len(w) + 1):
            for j in range(max(0, i - max(ends_in(w[i - 3 : i], 2) if i > 2 else 2, 2)), i - 1):  # longest piece first
                k = known(w[j:i])
                if k is None or reached[k] == 2:
                    continue
                if j:
                    key = last[j] << 22 | k
                    ok = pairs.get(key)
                    if not (self.stays(key) if ok is None else ok):
                        continue
                if self.alone(k):
                    last.append(k)
                    break
            else:
                k = self.number(w[i - 1])
                if i > 1:
                    key = last[i - 1] << 22 | k
                    ok = pairs.get(key)
                    if not (self.stays(key) if ok is None else ok):
                        k = self.number(self.merged(w[:i])[-1])
                last.append(k)

    def ids(self, w: str, last: list[int]) -> list[int]:
        out, i = [], len(w)
        while i:
            k = last[i]
            out.append(k)
            i -= len(self.piece[k]) if k < FREE else 1
        out.reverse()
        return out if max(out, default=0) < FREE else [x for k in out for x in ([k] if k < FREE else self.piece_ids(chr(k - FREE)))]

    def piece_ids(self, t: str) -> list[int]:
        k = self.id_of.get(t)
        if k is not None:
            return [k]
        return [self.byte_id[b] for b in t.encode()] if self.byte_id else [self.unk]

    def marks_ids(self, n: int) -> list[int]:
        out = []
        while n > 0:
            k = min(n, self.marks)
            out += self.piece_ids(MARK * k)
            n -= k
        return out

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct marked words in sorted order, each of at most one mark followed by other characters."""
        out, before, last = [], "", [0]
        for w in words:
            n = min(len(w), len(before))
            shared = next((i for i in range(n) if w[i] != before[i]), n)
            self.forward(w, last, shared)
            out.append(self.ids(w, last))
            before = w
        return out

    def encode_words(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks: marks, then characters other than marks and newlines (or a newline)."""
        bare = [c.lstrip(MARK) for c in chunks]
        marked = [(MARK if len(b) < len(c) else "") + b if b else "" for b, c in zip(bare, chunks)]
        distinct = sorted({m for m in marked if m})
        got = dict(zip(distinct, self.encode_sorted(distinct)))
        single = self.id_of.get(MARK)
        out = []
        for c, b, m in zip(chunks, bare, marked):
            n, ids = len(c) - len(b), got.get(m, [])
            if n and ids:
                if ids[0] == single:
                    ids = self.marks_ids(n) + ids[1:]
                else:
                    ids = self.marks_ids(n - 1) + ids
            out.append(ids if ids else self.marks_ids(n))
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw[raw[:1] == b" " :].decode("utf-8", "replace")


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode_slice(data: np.ndarray, offsets: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each); texts hold no literal mark."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
    space, line = data == 0x20, data == 0x0A
    cut = np.zeros(n, bool)
    cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    starts = offsets[:-1]
    head = np.zeros(n, bool)
    head[starts[starts < n]] = True
    cut |= head
    s = np.flatnonzero(cut)
    e = np.append(s[1:], n)
    different, back = C.distinct_ranges(data, s, e)
    s_, e_ = s[different], e[different]
    raw = data.tobytes()

    def encode(new, mark=""):
        return m.encode_words([mark + raw[a:b].decode().replace(" ", MARK) for a, b in zip(s_[new].tolist(), e_[new].tolist())])

    ids, size = m.words.look_up(data, s_, e_, encode)
    # the first piece of a text gets a mark before it: its content counts as another one
    heads = np.flatnonzero(head[s])
    own, at = np.unique(back[heads], return_inverse=True)
    marked = encode(own, MARK)
    back[heads] = len(different) + at
    ids = np.concatenate([ids, np.array([k for x in marked for k in x], ids.dtype)])
    ids, bounds = C.gather(ids, np.append(size, [len(x) for x in marked]), back)
    return ids.astype(np.uint32), np.diff(bounds[np.searchsorted(s, offsets)])


def _encoded(column, path: str):
    """(i, j, texts with spaces for marks, ids, ends) for slices of a text column."""
    m = model(path)
    mark = MARK.encode()
    data, offsets = C.text_bytes(column)
    raw = data.tobytes()
    if mark in raw:
        texts = [(t or "").replace(MARK, " ") for t in column.to_pylist()]
        data, offsets = C.text_bytes(pa.array(texts, pa.string()))
    for i, j in C.slices(offsets, SLICE):
        ids, n = encode_slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], m)
        yield i, j, data, offsets, ids, np.concatenate([[0], np.cumsum(n)])


def check(docs: DataFrame, path: str) -> DataFrame:
    """Ids' count and checksum, and the decoded text's digest, of every document."""

    def run(batches):
        for b in batches:
            for i, j, data, offsets, ids, ends in _encoded(b.column("text"), path):
                m = model(path)
                cols = {"n_tokens": [], "ids_crc32": [], "decoded_sha256": [], "round_trip": []}
                for k in range(j - i):
                    own = ids[ends[k] : ends[k + 1]]
                    text = m.decode(own).encode()
                    cols["n_tokens"].append(len(own))
                    cols["ids_crc32"].append(zlib.crc32(own.astype("<u4").tobytes()))
                    cols["decoded_sha256"].append(hashlib.sha256(text).hexdigest())
                    cols["round_trip"].append(text == data[offsets[i + k] : offsets[i + k + 1]].tobytes())
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(i, j - i).cast(pa.int64())} | cols)

    return docs.select("doc_id", "text").mapInArrow(C.released(run), OUT)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids array) of every row, in the rows' order; a missing source column is null."""
    has = "source" in docs.columns

    def run(batches):
        for b in batches:
            for i, j, _, _, ids, ends in _encoded(b.column("text"), path):
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                part = b.slice(i, j - i)
                source = part.column("source").cast(pa.string()) if has else pa.nulls(j - i, pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), source, pa.array(np.diff(ends)), lists], ["doc_id", "source", "n_tokens", "ids"])

    return docs.select("doc_id", "text", *["source"] * has).mapInArrow(C.released(run), "doc_id long, source string, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches):
        m = model(path)
        for b in batches:
            texts = [m.decode(np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(C.released(run), "doc_id long, text string")
