"""The field against all label sequences, on lines of another generator, and on the given documents."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa

from ledgerlake.llm import common as C
from ledgerlake.llm import crf, pii


def test_viterbi_equals_all_sequences():
    rng = np.random.default_rng(4)
    w = rng.normal(size=(len(crf.OFFSETS), crf.N_CLASSES, crf.N_LABELS)).astype(np.float32)
    tr = (rng.normal(size=(crf.N_LABELS, crf.N_LABELS)) + crf._allowed()).astype(np.float32)
    for n in (1, 2, 3):
        x = rng.integers(0, crf.N_CLASSES, (4, n))
        e = crf.emissions(x, w)
        got = crf.viterbi(x, np.full(4, n), w, tr)
        for r in range(4):
            score = lambda y: crf._START[y[0]] + sum(e[r, i, y[i]] for i in range(n)) + sum(tr[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
            assert tuple(got[r]) == max(itertools.product(range(crf.N_LABELS), repeat=n), key=score)


def other_lines(rng):
    """(line, start and end of what is to be found, kind) in other words and forms than the labelled table's."""
    word = lambda: "".join(rng.choice("bdfgjklmprstvz") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    prose = lambda: " ".join(rng.choice([word(), word().title()]) for _ in range(rng.randint(2, 9)))
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 1)) + "7"
    found = rng.choice(
        [
            lambda: ("secret", 'Token = "', hexa(40), '"'),
            lambda: ("secret", "PASSWORD: ", "Qx" + hexa(14), ","),
            lambda: ("secret", "api_key=", hexa(32), ""),
            lambda: ("secret", "secret = ", hexa(24), "!!"),
            lambda: ("email", "mail ", f"{word()} (at) {word()} (dot) org", "."),
            lambda: ("email", "", f"{word()} [at] {word()} [dot] net", ""),
            lambda: ("phone", "Tel: ", f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", ""),
            lambda: ("phone", "call ", f"{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}", "."),
        ]
    )()
    before = f"{prose()} {found[1]}"
    return before + found[2] + found[3] + " " + prose(), (len(before), len(before) + len(found[2]), found[0])


CLEAN = ["Chapter 12 of 30, 1998 to 2004.", "version 3.14.15 build 20240101", "commit 9fceb02d0ae598e95dc970b74767f19372d61af8 by me", "room A1B234 at 10:30, dot and at", "the token of the game is key", "ISBN 978-3-16-148410-0", "item #44812 costs 19.99", "1234567 people", "password is not here", "the key = value pairs", "order 4512 7781", "call the card a mail"]


def test_lines_of_another_generator():
    w, tr = pii.model()
    rng = random.Random(11)
    lines = [other_lines(rng) for _ in range(600)]
    got = list(pii.all_spans([t for t, _ in lines], *C.text_bytes(pa.array([t for t, _ in lines])), w, tr))
    right = [span in spans for (_, span), (_, spans) in zip(lines, got)]
    assert np.mean(right) > 0.9
    extra = [x for (_, span), (_, spans) in zip(lines, got) for x in spans if x != span]
    assert len(extra) < 0.05 * len(lines)
    clean = list(pii.all_spans(CLEAN, *C.text_bytes(pa.array(CLEAN)), w, tr))
    assert all(spans == base for base, spans in clean)


def test_given_documents_with_secrets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    secret = {d for d, t in texts.items() if re.search(r'(?i)\b(?:token|password|secret|api_key)\s*[=:]\s*"?[0-9a-z]{8}', t)}
    got = {r.doc_id: r for r in pii.find(df).collect()}
    found = {d for d, r in got.items() if "secret:" in r.spans}
    assert len(secret) > 5 and len(secret & found) > 0.9 * len(secret) and found <= secret
    by_field = {d for d, r in got.items() if r.spans and not r.n_email + r.n_ip + r.n_card + r.n_phone}
    assert by_field  # documents that the base patterns leave
    red = {r.doc_id: r.text or "" for r in pii.redact(df).collect()}
    assert all("<SECRET>" in red[d] for d in found)
    assert all(red[d] == t for d, t in texts.items() if not got[d].spans)


def test_long_lines_and_ties():
    w, tr = pii.model()
    long = "word " * 30_000 + 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + "word " * 30_000
    [(base, spans)] = pii.all_spans([long], *C.text_bytes(pa.array([long])), w, tr)
    assert base == [] and spans == [(150_009, 150_049, "secret")]
    assert pii.labels(np.zeros(0, np.int64), np.zeros(0, np.int64), w, tr).size == 0
    zero = np.zeros_like(w), np.zeros_like(tr)
    assert (crf.viterbi(np.ones((1, 5), np.int64), np.array([5]), *zero) == 0).all()  # equal scores: the first label
