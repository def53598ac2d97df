"""The n-gram join, hard negatives and the conversation trie against plain versions."""

import hashlib
import math
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import divideskip, negatives, turntrie
from tests.llm import brute
from tests.llm.test_dedup import planted, table

# ---------------------------------------------------------------- n-gram join


def likeness_rows(seed=5):
    """Texts of one template with 0 to 12 % of their words changed, chains of small steps, short texts and odd rows."""
    rng = random.Random(seed)
    word = lambda p: f"{p}{rng.randint(0, 10**6)}"
    rows, base = planted(), [word("t") for _ in range(150)]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = word("e")
        rows.append((300 + i, " ".join(w)))
    step = [word("c") for _ in range(200)]
    for i in range(25):  # each like the next, the ends unlike
        rows.append((400 + i, " ".join(step)))
        step[5 * i % 200] = word("d")
    for n in (8, 10, 11, 12, 20, 21, 40):
        w = [word("s") for _ in range(n)]
        rows += [(500 + 3 * n, " ".join(w)), (501 + 3 * n, " ".join([*w, word("z")])), (502 + 3 * n, " ".join(w[1:]))]
    rows += [(700, "One two THREE four"), (701, "one TWO three FOUR"), (702, "two one"), (703, "two one")]
    return [r for i, r in enumerate(rows) if r not in rows[:i]]


@pytest.mark.parametrize("limits, like", [({}, 90), ({"cluster": 6}, 90), ({"cluster": 2}, 80), ({"shingles": 500}, 90)])
def test_ngram_join(spark, limits, like):
    rows = likeness_rows()
    got = sorted(map(tuple, divideskip.linked(table(spark, rows), 3, like, **limits).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(r[:3] for r in brute.near_components(rows, 3, like))


def test_many_texts_outside_the_largest_component(spark):
    """Half of each text is common, so texts meet in one cluster; few of them are linked."""
    rng = random.Random(2)
    word = lambda: f"w{rng.randint(0, 10**7)}"
    common, rows = [word() for _ in range(400)], []
    for i in range(60):
        own = [word() for _ in range(60)]
        rows.append((2 * i, " ".join(common + own)))
        own[rng.randrange(60)] = word()
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(common + own)))
    want = sorted(r[:3] for r in brute.near_components(rows, 3, 90))
    for cluster in (1500, 8):
        got = sorted(map(tuple, divideskip.linked(table(spark, rows), 3, cluster=cluster).select("doc_id", "n_shingles", "component_id").collect()))
        assert got == want
    assert 1 < len({r[2] for r in want}) < len(want)


def template_rows(m, changed, seed=3, words=90):
    """Texts of one template, each with up to ``changed`` words of its own: all meet in one cluster, about half are linked."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(words)]
    rows = []
    for i in range(m):
        w = list(base)
        for _ in range(rng.randint(1, changed)):
            w[rng.randrange(words)] = f"e{rng.randint(0, 10**7)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("limits", [{"cluster": 12}, {"cluster": 12, "blocks": 1}, {"cluster": 12, "blocks": 1, "shingles": 2000}, {"blocks": 1, "shingles": 900}])
def test_large_cluster_of_a_template(spark, limits):
    """By pairs of blocks, by short lists, and by the large lists of a cluster at once."""
    rows = template_rows(90, 5)
    got = sorted(map(tuple, divideskip.linked(table(spark, rows), 3, **limits).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(r[:3] for r in brute.near_components(rows, 3, 90))


def test_template_is_searched_without_a_lookup_for_each_pair():
    """Pairs of one template are looked up together: 1,200 sets of 200 shingles took 23 s pair by pair."""
    from ledgerlake.llm.chosenpath import shingle_sets

    text = [t.encode() for _, t in template_rows(1200, 14, words=202)]
    value, bounds = shingle_sets(np.frombuffer(b"".join(text), np.uint8), np.cumsum([0, *map(len, text)]), 3)
    n = np.diff(bounds)
    order = np.argsort(n, kind="stable")
    sets = [value[bounds[i] : bounds[i + 1]] for i in order]
    n = n[order]
    began = time.process_time()
    u = divideskip.joined(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]), 90, np.ones(len(n), bool))
    assert time.process_time() - began < 6
    shingles, code = np.unique(np.concatenate(sets), return_inverse=True)
    dense = np.zeros((len(n), len(shingles)), np.float32)
    dense[np.repeat(np.arange(len(n)), n), code] = 1
    both = np.rint(dense @ dense.T).astype(int)
    want = list(range(len(n)))
    for i, j in np.argwhere(np.triu(100 * both >= 90 * (n[:, None] + n - both), 1)).tolist():
        a, b = want[i], want[j]
        if a != b:
            want = [min(a, b) if c in (a, b) else c for c in want]
    got = [u.find(i) for i in range(len(n))]
    assert got == want and 1 < len(set(got)) < len(got)


def test_lists_count_what_they_hold():
    rng = np.random.default_rng(4)
    sets = [np.unique(np.concatenate([rng.choice(150, rng.integers(1, 90)), 1000 + rng.choice(5000, 20)])).astype(np.uint64) for _ in range(200)]
    index = divideskip.Lists(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert (index.column < 0).any() and index.bits.shape[1] > 1
    names = np.unique(np.concatenate(sets))
    for some in (rng.choice(len(names), 40, replace=False), np.flatnonzero(index.column < 0)[:30], np.flatnonzero(index.column >= 0)[70:90], np.zeros(0, np.int64)):
        for places in (np.arange(200), np.array([3]), np.array([0, 17, 150, 199]), np.zeros(0, np.int64)):
            assert index.held(some, places).tolist() == [len(np.intersect1d(names[some], sets[p])) for p in places.tolist()]


def test_search_space_is_exact():
    """Every pair at the threshold shares a segment, whatever its sizes."""
    rng = np.random.default_rng(1)
    for n in [*range(1, 60), 100, 333, 1000, 5000]:
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for extra in {0, n // 9, int(n * 0.05)}:
            drop = 0 if extra == n // 9 else extra
            y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
            both = n - drop
            if 100 * both < 90 * (n + len(y) - both):
                continue
            value, bounds = np.concatenate([np.sort(x), y]), np.array([0, n, n + len(y)])
            row, name = divideskip.segment_names(value, bounds, 90)
            assert set(name[row == 0].tolist()) & set(name[row == 1].tolist()), (n, extra)


def test_divided_lists_count_occurrences():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sets = [np.unique(rng.integers(0, 80, rng.integers(1, 50)).astype(np.uint64)) for _ in range(30)]
        sets.sort(key=len)
        n = np.array([len(s) for s in sets])
        u = divideskip.joined(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]), 50, np.ones(30, bool))
        up = list(range(30))
        find = lambda x: x if up[x] == x else find(up[x])
        for i in range(30):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 50 * (n[i] + n[j] - both):
                    a, b = find(i), find(j)
                    up[max(a, b)] = min(a, b)
        assert [u.find(i) for i in range(30)] == [find(i) for i in range(30)]
    assert divideskip.divided(np.array([9, 9, 9]), 1) == 0
    assert divideskip.divided(np.array([0, 0, 1, 5000, 5000]), 4) == 3
    assert divideskip.divided(np.array([], int), 3) == 0
    assert divideskip.occurrences([np.array([1, 4]), np.array([], int), np.array([4])]) == [(1, 1), (4, 2)]


def test_sets_of_one_name_are_parted(spark, monkeypatch):
    rows = [(i, f"a{i} b{i} c{i} d{i}") for i in range(6)] + [(9, "a1 b1 c1 d1")]
    real = divideskip.set_names
    monkeypatch.setattr(divideskip, "set_names", lambda v, b: (np.full(len(b) - 1, 7, np.uint64), real(v, b)[1]))
    got = sorted(map(tuple, divideskip.linked(table(spark, rows).coalesce(1), 3).select("doc_id", "component_id").collect()))
    assert got == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (9, 1)]


def test_ngram_join_of_no_rows_null_ids_and_long_texts(spark):
    assert divideskip.linked(table(spark, [(1, "x")]).where("false")).count() == 0
    long = " ".join(f"w{i * 7919 % 100003}" for i in range(400_000))
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (None, None), (6, long), (7, long + " end")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in divideskip.linked(table(spark, rows)).collect())
    assert got == [(-1, -1), (-1, 4), (-1, 4), (4, 4), (6, 6), (7, 6)]


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows, every, k, positives, low, high):
    """rows: (vec_id, vector, label)."""
    kept = [(i, r[0], [math.floor(256 * float(x)) for x in r[1]], r[2]) for i, r in enumerate(rows) if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    last = lambda v: (1 << 63) - 1 if v is None else v
    out = []
    for n, a, q, label in kept:
        if a is None or a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), last(i), m, other) for m, i, v, other in kept), key=lambda t: t[:2])
        for s, p, m, _ in [t for t in scored if t[3] == label and t[2] != n][:positives]:
            fit = [t for t in scored if t[3] != label and low * -s <= 100 * -t[0] <= high * -s][:k]
            out += [(a, p if p != last(None) else None, r, i if i != last(None) else None, -s, -t) for r, (t, i, _, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, label int, rn string, i int, q string"


@pytest.mark.parametrize("blocks", [{}, {"block": 7, "at_most": 3}, {"block": 40, "at_most": 1}])
def test_hard_negatives(spark, blocks):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 6).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(90)]
    rows += [(100 + i, rows[i % 4][1], i % 3) for i in range(12)]  # one vector many times
    rows += [rows[10], rows[20], rows[20], (None, rows[3][1], 1), (None, rows[5][1], None), (200, None, 1), (210, [0.1, None, 0.2, 0.3, 0.4, 0.5], 0), (220, [float("nan")] * 6, 1), (230, [float("inf")] + [0.0] * 5, 1)]
    rows += [(240, [], 1), (250, [0.0] * 6, 2), (260, [0.25, 0.5], 0), (270, [3.0e30] * 6, 1), (-10, rows[7][1], 1)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS).repartition(3)
    got = sorted(map(tuple, negatives.hard_negatives(df, 10, k=4, positives=3, **blocks).collect()), key=str)
    assert got == plain_negatives([r for r in rows if r[0] != 270], 10, 4, 3, 30, 90)
    assert negatives.hard_negatives(df.where("false")).count() == 0
    assert negatives.hard_negatives(df.where("vec_id = 1")).count() == 0


def test_scores_beyond_floating_point_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 1e6, 4)).astype(np.float32).tolist(), i % 2) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)
    got = sorted(map(tuple, negatives.hard_negatives(df, 10).collect()), key=str)
    assert got == plain_negatives(rows, 10, 10, 5, 30, 90) and got


# ---------------------------------------------------------------- conversation trie


def plain_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h]) + tuple(own[h:])
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    below = defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)
    out = []

    def walk(p):
        totals = [walk(k) for k in below[p]]
        saved = (len(members[p]) - 1) * (len(brute.WORD.findall(p[-1][1])) if p else 0) + sum(s for _, s in totals)
        leaves = sum(n for n, _ in totals) or 1
        ends = ",".join(map(str, sorted(c for c in members[p] if len(rebuilt[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        walk(())
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, node string, part int, key string, t int"


def turn_rows():
    rng = random.Random(6)
    rows = []
    for c in range(140):
        first = rng.choice(["hello there", "hi", None, ""])
        rows.append((c, 0, "system", first))
        for t in range(1, rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "d e f", None, "  "])))
    for c in range(200, 260):  # one conversation many times
        rows += [(c, 0, "user", "same text"), (c, 1, "assistant", "same answer")]
    rows += [(300, 5, "user", "late"), (300, None, "user", "no turn"), (301, 1, "user", "x"), (301, 1, "user", "x"), (None, 1, "user", "no id"), (None, None, None, None), (-25, 0, "user", "minus"), (-20, 0, "user", "base"), (320, 0, "user", "one turn"), (321, 0, "u", "only"), (322, 0, "u", "only"), (323, 0, "u", "only")]
    rows += [(400, t, "user", f"turn {t}") for t in range(300)] + [(401, t, "user", f"turn {t}" if t < 250 else "other") for t in range(300)]
    rows += [(500, 0, "user", "long " * 200_000)]
    return rows


@pytest.mark.parametrize("at_most", [200_000, 40, 7])
def test_conversation_trie(spark, at_most):
    rows = turn_rows()
    df = spark.createDataFrame([(*r, "n", 1, "k", 2) for r in rows], TURNS).repartition(5)
    got = sorted(map(tuple, turntrie.conversation_trie(df, at_most=at_most).collect()), key=str)
    assert got == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    df = spark.createDataFrame([], TURNS)
    assert turntrie.conversation_trie(df).count() == 0
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 21, 23, 41)]  # without a base, most lose their only turn
    df = spark.createDataFrame([(*r, "n", 1, "k", 2) for r in rows], TURNS)
    assert sorted(map(tuple, turntrie.conversation_trie(df).collect()), key=str) == plain_trie(rows)


def test_common_prefix_of_arrays():
    token = lambda k: hashlib.md5(str(k).encode()).digest()
    a = b"".join(map(token, range(9)))
    assert turntrie.common(a, a) == 9 and turntrie.common(b"", a) == 0
    assert turntrie.common(a, b"".join(map(token, [0, 1, 2, 7]))) == 3


def test_queries_equal_their_sql(spark):
    """On the smallest tables, for the queries whose SQL covers them whole."""
    duckdb = pytest.importorskip("duckdb")
    from ledgerlake.llm import queries as q

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    for n in ("op11_ngram_join", "op12_hard_negatives", "op13_conversation_trie"):
        df = q.QUERIES[n](spark, folder)
        cols = sorted(df.columns)
        want = con.execute(f"select {', '.join(cols)} from ({q.ORACLES[n]})").fetchall()
        assert sorted(map(tuple, df.select(*map(F.col, cols)).collect()), key=str) == sorted(want, key=str), n
