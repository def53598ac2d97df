"""Fingerprints, pieces, personal data, pages, quality: against plain versions and on edge cases."""

import hashlib
import html as entities
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ledgerlake.llm import crf, fingerprint, html, pieces, pii, quality
from ledgerlake.llm import common as C
from tests.llm import brute

EDGE = [(1, None), (2, ""), (3, " \n "), (4, "short"), (5, "é" * 50), (6, "word " * 3000), (6, "word " * 3000), (None, "no id here")]


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "h") for d, t in rows], "doc_id long, text string, part string, n_chars long, kept string")


# ---------------------------------------------------------------- fingerprints


@pytest.mark.parametrize("part_bytes", [48 << 20, 2000])
def test_fingerprints(spark, part_bytes):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randint(0, 999)}é" for _ in range(rng.randint(0, 200)))) for i in range(40)]
    rows += [(50, rows[3][1]), (60, None), (61, "")]
    got = {r.doc_id: r for r in fingerprint.compare(docs(spark, rows).repartition(3), part_bytes).collect()}
    order = sorted(rows, reverse=True)
    for (d, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        cut = len(t) // 3
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == brute.sha(t[: len(t) - cut] + n[:cut])
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    assert got[50].fingerprint == got[3].fingerprint != got[4].fingerprint
    long = [got[d] for d, t in rows if t and len(t) > 500]
    assert min(r.near_edited for r in long) > max(r.near_next for r in long)


def plain_fingerprint(raw: bytes):
    """Slots of closed syncmers, one k-mer at a time."""
    k, s = fingerprint.K, fingerprint.S
    h8 = lambda b: int(C.mix(np.array([int.from_bytes(b, "little")], np.uint64))[0])
    slots = {}
    for i in range(len(raw) - k + 1):
        inner = [h8(raw[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            e = [np.array([int.from_bytes(raw[i + j : i + j + 8], "little")], np.uint64) for j in (0, 8, 16)]
            h = int(C.mix(e[0] ^ C.mix(e[1] ^ C.mix(e[2])))[0])
            slots[h % fingerprint.SLOTS] = min(slots.get(h % fingerprint.SLOTS, (h, i)), (h, i))
    if raw and not slots:
        h = int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")
        slots[h % fingerprint.SLOTS] = (h, 0)
    return slots


def plain_likeness(a, b):
    used = set(a) | set(b)
    if not used:
        return 1.0
    moves = sorted(a[x][1] - b[x][1] for x in set(a) & set(b) if a[x][0] == b[x][0])
    return sum(abs(m - moves[len(moves) // 2]) <= fingerprint.NEAR_BYTES for m in moves) / len(used) if moves else 0.0


def test_fingerprints_equal_a_plain_version(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randint(0, 99)}é" for _ in range(rng.choice([0, 1, 5, 60])))) for i in range(14)] + [(None, "no id " * 9), (None, None), (3, "again")]
    got = {(r.doc_id, r.edited_sha256): r for r in fingerprint.compare(docs(spark, rows).repartition(3), 500).collect()}
    seen = set()
    order = fingerprint.compare(docs(spark, rows).coalesce(1), 1 << 30).collect()
    assert sorted(map(str, order)) == sorted(map(str, got.values()))
    known = [r for r in rows if r[0] is not None and r[0] != 3]
    ordered = sorted(known, key=lambda r: -r[0])
    for (d, t), (e, n) in zip(ordered, ordered[1:]):
        if d - e != 1:
            continue
        new = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        r = got[d, brute.sha(new)]
        a, b, c = (plain_fingerprint(x.encode()) for x in (t, new, n))
        show = lambda f: ",".join(f"{f[k][0]:016x}.{f[k][1]:x}" if k in f else "-" for k in range(fingerprint.SLOTS)) if f else ""
        assert (r.fingerprint, r.edited_fingerprint) == (show(a), show(b))
        assert abs(r.near_edited - plain_likeness(a, b)) < 1e-12 and abs(r.near_next - plain_likeness(a, c)) < 1e-12
        seen.add(d)
    assert len(seen) > 8


def test_anchors_are_free_of_context():
    rng = np.random.default_rng(1)
    mid = bytes(rng.integers(32, 127, 500).astype(np.uint8))
    a, b = (fingerprint.anchors(x + mid + y) for x, y in ((b"", b"tail" * 20), (b"head" * 31, b"")))
    inside = lambda f, s: {(h, p - s) for h, p in zip(f[0].tolist(), f[1].tolist()) if s <= p <= s + 500 - fingerprint.K}
    assert inside(a, 0) == inside(b, 124) and len(inside(a, 0)) > 30
    whole = fingerprint.fingerprint(mid * 3)
    cut = fingerprint.fingerprint(mid * 3, piece=100)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_fingerprint_edges(spark):
    assert fingerprint.compare(docs(spark, EDGE)).count() == len(EDGE)
    assert fingerprint.compare(docs(spark, EDGE).limit(0)).count() == 0
    one = fingerprint.compare(docs(spark, [(9, "alone")])).first()
    assert one.near_next == 1.0


# ---------------------------------------------------------------- pieces


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:60]
    texts += ["", None, "  ", " a", "a  b\n c\tx  ", "▁x ▁", "日本語 テスト", "   " * 20 + "x", "x" + " " * 33, "<s>a</s><0x41>", "a" * 40, "\u0000é"]
    texts += ["".join(rng.choice("ab c\n▁éß=-.eting") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    df = docs(spark, list(enumerate(texts))).repartition(2)
    got = {r.doc_id: r.ids for r in pieces.encode(df, path).collect()}
    assert all(got[i] == sp.encode(t or "") for i, t in enumerate(texts))
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, path), path).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    checked = pieces.check(df, path).collect()
    assert all(r.round_trip and r.n_tokens == len(got[r.doc_id]) for r in checked)


def test_pieces_edges(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert pieces.check(docs(spark, EDGE), path).count() == len(EDGE) and pieces.check(docs(spark, EDGE).limit(0), path).count() == 0


# ---------------------------------------------------------------- personal data

# The base patterns as given
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for k, p in BASE.items():
        for m in re.finditer(p, t):
            d = re.sub(r"\D", "", m.group())
            ok = k == "email" or k == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or k == "card" and 12 <= len(d) <= 19 and pii.luhn(d) or k == "phone" and 9 <= len(d) <= 15
            if ok:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda x: (x[0], pii.KINDS.index(x[2])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    texts = ["a@b.c@d.e", "x..y@z.co.", "@a.b", "é@a.b", "a@@b.c", "a@b@c.d", "1.2.3.4.5.6.7.8", "1.2.3", "0001.2.3.256", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "+1 (555) 010-9999.", "+1+15550109999", "+1 ((((", "12 34"]
    texts += ["".join(rng.choice("a1.@+-() 4é") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_field_on_held_out_lines():
    w, tr = pii.model()
    held = crf.labelled_table(300, seed=77)
    x, y = crf.encoded(held)
    got = crf.viterbi(x, (y >= 0).sum(1), w, tr)
    assert (got[y >= 0] == y[y >= 0]).mean() > 0.99
    flat = np.concatenate([a[b >= 0] for a, b in zip(x, y)])
    line = np.repeat(np.arange(len(held)), (y >= 0).sum(1))
    assert (pii.labels(flat, line, w, tr) == np.concatenate([a[b >= 0] for a, b in zip(got, y)])).all()


def test_personal_data(spark):
    rows = EDGE + [(20, "call 555-010-9999 or mail anna (at) home (dot) org, é +1 555 010 9999."), (21, "clean text. At at at version 3.1.4 in 2024, 12 apples")]
    got = {(r.doc_id, r.spans): r for r in pii.find(docs(spark, rows)).collect()}
    by = {k[0]: r for k, r in got.items()}
    assert by[20].n_phone == 1 and by[20].spans == "phone:5:17,email:26:50,phone:54:69"
    assert by[21].spans == "" and by[21].base_sha256 == brute.sha("")
    red = {r.doc_id: r for r in pii.redact(docs(spark, rows)).collect()}
    assert red[20].text == "call <PHONE> or mail <EMAIL>, é <PHONE>." and red[20].n_chars == len(red[20].text)
    assert red[1].text is None and red[21].text == rows[-1][1] and red[20].kept == "h"
    assert pii.find(docs(spark, EDGE).limit(0)).count() == 0


# ---------------------------------------------------------------- pages


def test_blocks():
    page = "<html><head><title>t</title></head><body><nav>menu</nav><header>top</header><div class='cookie-banner'>ok?</div><main><h1>T &amp; x</h1><p>one<br>two <b>bold</b><p>three &lt;b&gt;&nbsp;end<ul><li>i<li>j</ul><aside>side</aside><div id=comments>c</div><form>f</form></main><footer>end</footer><script>var t='</p>';</script>"
    assert [t for t, inside in html.blocks(page) if inside] == ["T & x", "one two bold", "three <b> end", "i", "j"]
    wrapped = "<div class='with-sidebar'><article><div class='post-header'><h1>T</h1></div><p>x</p></article></div>"
    assert html.blocks(wrapped) == [] and html.blocks(wrapped, wrappers=False) == [("T", True), ("x", True)]
    assert html.blocks("") == [] and html.blocks("<p") == [("<p", False)] and html.blocks("a < b") == [("a < b", False)]
    assert html.blocks("<p>a<div>b</div>c<!-- <p>no</p> -->") == [("a", False), ("b", False), ("c", False)]
    assert html.blocks("<p>an <svg><text>icon</text></svg> inline <button>press</button> part <math>x</math></p>") == [("an inline part x", False)]
    assert html.blocks("<p title=it's>q&#99999999999;&#0000065;<a title=\"x>y</a>") == [("q\ufffdAy", False)]


HOSTILE = ["<a \"", "<a =\"", "<a ='>", "<!", "<", "<b>", "<div>", "<p>x", "</p>", "<![CDATA[", "<!--", "&#9", "<script>", "<script></script ", "<a class=", "<svg>", "<li><a href='#'>x"]


@pytest.mark.parametrize("unit", HOSTILE)
def test_hostile_pages_take_linear_time(unit):
    import time

    took = []
    for size in (100_000, 1_000_000):
        page = unit * (size // len(unit))
        began = time.perf_counter()
        html.parts(page)
        html.parts(page + "</x>" * 1000 + "<hr>" * 1000 + ">")
        took.append(time.perf_counter() - began)
    assert took[1] < max(40 * took[0], 2) and took[1] < 8


def test_suffix_array_and_repeats():
    rng = np.random.default_rng(7)
    t = rng.integers(0, 4, 300)
    sa, lcp = html.suffix_array(t)
    raw = t.tolist()
    assert [raw[i:] for i in sa] == sorted(raw[i:] for i in range(300))
    page = np.repeat(np.arange(10), 30)
    t[29::30] = 100 + np.arange(10)
    page[29::30] = -1
    mark = html.repeated(t, page, 4, 3)
    seen = {}
    for i in range(297):
        if len(set(page[i : i + 4])) == 1 and page[i] >= 0:
            seen.setdefault(tuple(t[i : i + 4]), []).append(i)
    want = np.zeros(300, bool)
    for places in seen.values():
        if len({page[i] for i in places}) >= 3:
            for i in places:
                want[i : i + 4] = True
    assert (mark == want).all()


def test_main_text(spark):
    rows = [(i, f"http://h.org/{i}", f"<div>Home About Contact us today</div><p>unique {i} words w{i} x{i}</p><p>All rights reserved by the house</p><p>Top</p>") for i in range(30)]
    rows += [(100, None, None), (101, "http://x.org", ""), (102, "http://h.org/art", "<article><p>Home About Contact us today</p></article>"), (102, "http://h.org/art", "<article><p>Home About Contact us today</p></article>"), (None, "u", "<p>lone page</p>")]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, part int")
    got = Counter((r.page_id, r.text, r.n_chars) for r in html.extract(df, group=10).collect())
    assert all(got[i, t, len(t)] == 1 for i in range(30) for t in [f"unique {i} words w{i} x{i}"])
    assert got[100, "", 0] == got[101, "", 0] == 1 and got[102, "Home About Contact us today", 27] == 2 and got[None, "lone page", 9] == 1
    assert html.extract(df.limit(0)).count() == 0


def test_shared_blocks_of_articles(spark):
    rows = [(i, f"http://h.org/{i}", f"<article><p>unique {i}</p><p>Share this with all your friends</p>{'<p>seen on a third of them</p>' if i % 3 == 0 else ''}</article>") for i in range(12)]
    rows += [(100 + i, "http://copies.org", "<main><p>one article in many copies</p></main>") for i in range(5)]
    rows += [(200 + i, f"http://two.org/{i}", f"<main><p>on both pages</p><p>{i}</p></main>") for i in range(2)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"unique {i}" + ("\nseen on a third of them" if i % 3 == 0 else "") for i in range(12))
    assert all(got[100 + i] == "one article in many copies" for i in range(5)) and got[201] == "on both pages\n1"


def test_runs_are_counted_over_the_whole_host(spark):
    notice = {3: "five pages hold this notice here", 7: "Top story", 11: "two pages hold this other notice"}
    rows = []
    for i in range(60):
        held = "".join(f"<p>{t}</p>" for k, t in notice.items() if i % k == 0 and i < (k * 5 if k < 11 else 22))
        rows.append((i, f"http://h.org/{i}", f"<p>unique {i} words w{i} x{i}</p>{held}"))
    rows.append((60, "http://h.org/copy", rows[11][2]))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (4, 200):
        got = {r.page_id: r.text for r in html.extract(df, group=size).collect()}
        for i in range(60):
            assert got[i] == f"unique {i} words w{i} x{i}" + ("\ntwo pages hold this other notice" if i in (0, 11) else "")
        assert got[60] == got[11]


def test_runs_inside_loose_blocks_go(spark):
    """No article, neutral class names: a passage inside longer blocks goes, their unique words stay; a heading that three articles share stays."""
    notice = "this notice of fifteen words stands inside longer blocks of many pages on this site"
    rows = []
    for i in range(12):
        own = [" ".join(f"{p}{i}_{k}" for k in range(20)) for p in "ab"]
        held = f"{own[0]} {notice} {own[1]}" if i < 7 else f"{own[0]} {own[1]}"
        rows.append((i, f"http://h.org/{i}", f"<div class=x><p>{held}</p></div><div class=y>{notice if i == 9 else f'end {i}'}</div>"))
    rows += [(100 + i, f"http://a.org/{i}", f"<article><h1>One heading that three of these articles share</h1><p>text {i} of its own</p></article>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (2, 200):
        got = {r.page_id: r.text for r in html.extract(df, group=size).collect()}
        for i in range(12):
            own = " ".join(f"{p}{i}_{k}" for p in "ab" for k in range(20))
            assert got[i] == own + ("" if i == 9 else f"\nend {i}"), i
        assert all(got[100 + i] == f"One heading that three of these articles share\ntext {i} of its own" for i in range(3))
    assert html.without("a b c d", [(0, 1), (2, 3)]) == "b d"


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_pages(spark, folder):
    df = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
    want = {}
    for r in df.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S).group(1)
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?p>|</?h1>", inner)]
        want[r.page_id] = "\n".join(x for x in parts if x)
    assert {r.page_id: r.text for r in html.extract(df).collect()} == want


# ---------------------------------------------------------------- quality


def plain_counts(t):
    w = brute.WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if brute.WORD.search(x)]
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep)


def test_rule_counts():
    rng = random.Random(5)
    texts = [None, "", "\n\n", "a\na\n\na", "x y z x y z", "a b\r\na b\r\n", "é # é"] + ["".join(rng.choice("ab #\n\té*") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    data, off = C.text_bytes(pa.array(texts))
    c = quality.base_counts(data, off)
    got = list(zip(*(c[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [plain_counts(t) for t in texts]


def test_quality_verdicts(spark):
    rng = random.Random(6)
    clean = lambda: " ".join(rng.choice("the of and river stone light water moon".split()) + rng.choice(["", "s", ","]) for _ in range(120))
    junk = lambda: " ".join(rng.choice("zz qq xx".split()) + rng.choice("###,%%%,$$$".split(",")) + str(rng.randint(0, 99)) for _ in range(120))
    rows = [(i, clean() if i % 3 else junk()) for i in range(90)] + [(200 + d if d else None, t) for d, t in EDGE]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(45)] + [(None, 1, 0), (3000, None, 0), (1, 5, 0), (0, 1, 0), (-1, 1, 0)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows)
    got = quality.judge(df, labels).collect()
    assert len(got) == len(rows)
    assert all(r.kept == (not r.base_failed and r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 90)
    kept = quality.keep(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    again = quality.judge(df.unionByName(df.where("doc_id < 45")), labels).collect()  # repeated rows are judged alike
    assert {(r.doc_id, r.kept) for r in again if r.doc_id is not None} == {(r.doc_id, r.kept) for r in got if r.doc_id is not None}
    none = quality.judge(df, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)
    assert quality.judge(df.limit(0), labels).count() == 0


def test_scores_equal_a_plain_version(spark):
    """Log ratios of word and bigram cells, counted one by one."""
    import math

    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(("Stone", "river", "moon,", "q#", "x1")) for _ in range(rng.choice([0, 3, 80])))) for i in range(40)] + [(None, "Stone river"), (41, None)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    cells = {}

    def features(t):
        words = re.findall(r"[a-z0-9]+|[^\sa-z0-9]+", (t or "").lower())
        for x in [*words, *zip(words, words[1:])]:
            if x not in cells:
                f, _ = quality.features(*C.text_bytes(pa.array([x if isinstance(x, str) else " ".join(x)])))
                cells[x] = int(f[-1])
        return [cells[x] for x in [*words, *zip(words, words[1:])]]

    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(features(t))
        if d is not None and d < 30 and d % 2:
            target.update(features(t))
    n_raw, n_target = sum(raw.values()) + quality.BUCKETS, sum(target.values())
    smooth = 0.05 * max(n_target, 1) + 1
    ratio = lambda c: math.log((target[c] + smooth * (raw[c] + 1) / n_raw) / (n_target + smooth)) - math.log((raw[c] + 1) / n_raw)
    want = {d: sum(map(ratio, features(t))) / max(len(features(t)), 1) for d, t in rows}
    got = quality.judge(docs(spark, rows), labels).collect()
    assert all(abs(r.score - want[r.doc_id]) < 1e-9 for r in got) and len({round(r.score, 6) for r in got}) > 5
    good, bad = ([r.score for r in got if r.doc_id is not None and r.doc_id < 30 and r.doc_id % 2 == q and not r.base_failed] for q in (1, 0))
    cut = quality.best_threshold(np.array(good), np.array(bad))
    assert all(r.kept == (not r.base_failed and r.score >= cut) for r in got)


def test_threshold_stands_in_the_widest_gap():
    assert quality.best_threshold(np.array([1.0, 2.0]), np.array([-1.0, 0.0])) == 0.5
    assert quality.best_threshold(np.array([1.0]), np.array([])) == -np.inf
