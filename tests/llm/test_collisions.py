"""Words that polynomial hashes modulo 2**64 can't tell apart, and hashes that fail altogether: results stay right."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ledgerlake.llm import chosenpath, pieces, quality, substringdedup, suffixdedup, tokenfile
from ledgerlake.llm import common as C
from tests.llm import brute
from tests.llm.test_dedup import table
from tests.llm.test_texts import plain_counts


def thue_morse(a, b, n=1024):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


X, Y = thue_morse("a", "b"), thue_morse("b", "a")
A, B = " ".join(X), " ".join(Y)
ROWS = [(1, X), (2, Y), (3, f"{X}\n{Y}"), (4, A), (5, B), (6, f"{X} {Y} and {X} more {Y}"), (7, None), (8, f"{A} x {B}")]


def test_hashes_tell_them_apart():
    data = np.frombuffer((X + Y).encode(), np.uint8)
    h = C.range_hashes(data, np.array([0, 1024, 0]), np.array([1024, 2048, 300]))
    assert len(set(h.tolist())) == 3
    assert C.window_hashes(data[:1024], 1024) != C.window_hashes(data[1024:], 1024)


@pytest.fixture(params=["real", "constant"])
def hashes(request, monkeypatch):
    if request.param == "constant":
        monkeypatch.setattr(C, "range_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    return request.param


def test_different_ranges_stay_different(hashes):
    raw = b"abcabdabc" + b"q" * 600 + b"r" * 600 + b"q" * 600
    s, e = np.array([0, 3, 6, 9, 609, 1209, 5, 0]), np.array([3, 6, 9, 609, 1209, 1809, 5, 0])
    first, back = C.distinct_ranges(np.frombuffer(raw, np.uint8), s, e)
    text = [raw[a:b] for a, b in zip(s, e)]
    assert [text[i] for i in first[back]] == text and len(first) == len(set(text))


def test_rule_counts(hashes):
    texts = [t for _, t in ROWS] + ["x y z x y z", "a\nb\na"]
    c = quality.base_counts(*C.text_bytes(pa.array(texts)))
    assert list(zip(*(c[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))) == [plain_counts(t) for t in texts]


def test_token_ids(hashes):
    own = tokenfile.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t for _, t in ROWS]
    ids, n = tokenfile.encode_slice(*C.text_bytes(pa.array(texts)), own)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [own.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_piece_ids(hashes):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for _, t in ROWS]
    ids, n = pieces.encode_slice(*C.text_bytes(pa.array(texts)), pieces.Model(path))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [sp.encode(t or "") for t in texts]


def test_dedup(spark):
    df = table(spark, ROWS)
    assert sorted(map(tuple, suffixdedup.digest(df).collect())) == sorted((d, *x) for (d, _), x in zip(ROWS, brute.byte_dedup([t for _, t in ROWS])))
    assert sorted(map(tuple, substringdedup.digest(df).collect())) == sorted(brute.word_dedup(ROWS))
    got = sorted(map(tuple, chosenpath.grouped(df, 4).select("doc_id", "n_shingles", "component_id", "kept").collect()))
    assert got == sorted(brute.near_components(ROWS))


def test_registered_queries_on_them(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenfile.write(table(spark, ROWS), f"file://{tmp_path}/t", path)
    t = Tokenizer.from_file(path)
    want = {d: zlib.crc32(np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for d, x in ROWS}
    assert {r.doc_id: r.ids_crc32 for r in tokenfile.read(spark, f"file://{tmp_path}/t").collect()} == want
    assert all(r.round_trip for r in pieces.check(table(spark, ROWS), public_tokenizers.path("piece_bpe_32k.model")).collect())
