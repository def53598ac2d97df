"""Byte, word and near dedup against plain versions, with planted cases."""

import random

import pyarrow as pa
import pytest

from ledgerlake.llm import chosenpath, repeats, substringdedup, suffixdedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, key string, doc int, spans string, set_id string, part int"


def table(spark, rows):
    """With further columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "k", 1, "s", None, 2) for d, t in rows], SCHEMA).repartition(3)


def planted():
    rng = random.Random(1)
    word = lambda p: f"{p}{rng.randint(0, 10**6)}"
    hot = [word("w") for _ in range(70)]
    base = [word("b") for _ in range(120)]
    rows = []
    for i in range(24):  # a passage that many documents share
        rows.append((i, " ".join([word("p") for _ in range(rng.randint(0, 40))] + hot + [word("q") for _ in range(rng.randint(0, 40))])))
    for i in range(20):  # near copies
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = word("e")
        rows.append((100 + i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "a" * 700), (204, "ab" * 300), (205, "x " * 150), (205, "x " * 150), (206, " ".join(hot + hot)), (207, "é" * 300), (208, "one two"), (209, "One\ttwo"), (210, "\n".join(hot))]
    return rows


@pytest.fixture(scope="module")
def rows():
    return planted()


@pytest.mark.parametrize("group, twins", [(20_000, False), (5, False), (20_000, True)])
def test_byte_dedup(spark, rows, group, twins):
    got = sorted(map(tuple, suffixdedup.digest(table(spark, rows), group=group, twins=twins).collect()))
    assert got == sorted((d, *x) for (d, _), x in zip(rows, brute.byte_dedup([t for _, t in rows])))


@pytest.mark.parametrize("group", [20_000, 5])
def test_word_dedup(spark, rows, group):
    got = sorted(map(tuple, substringdedup.digest(table(spark, rows), group=group).collect()))
    assert got == sorted(brute.word_dedup(rows))


@pytest.mark.parametrize("limits", [{}, {"node": 8, "cluster": 8}, {"node": 4, "cluster": 1500, "shingles": 400}, {"node": 6, "cluster": 2}])
def test_near_dedup(spark, rows, limits):
    distinct = [r for i, r in enumerate(rows) if r not in rows[:i]]
    got = sorted(map(tuple, chosenpath.grouped(table(spark, distinct), 4, **limits).select("doc_id", "n_shingles", "component_id", "kept").collect()))
    assert got == sorted(brute.near_components(distinct))


def test_recall_where_nodes_are_dealt_in_parts_and_the_exact_way(spark):
    """Pairs of likeness just over 0.8 in one template's crowd: their nodes are larger than a part. The trees find nearly all, the exact way all."""
    rng = random.Random(7)
    word = lambda: f"w{rng.randint(0, 10**7)}"
    common, rows = [word() for _ in range(150)], []
    for i in range(150):
        own = [word() for _ in range(150)]
        rows.append((2 * i, " ".join(common + own)))
        for _ in range(8):
            own[rng.randrange(150)] = word()
        rows.append((2 * i + 1, " ".join(common + own)))
    want = {d: c for d, _, c, _ in brute.near_components(rows)}
    pairs = [d for d, c in want.items() if c != d]
    assert len(pairs) > 100
    df = table(spark, rows)
    found = {r.doc_id: r.component_id for r in chosenpath.grouped(df, 4, node=20, cluster=40).collect()}
    assert sum(found[d] == want[d] for d in pairs) >= 0.97 * len(pairs)
    assert {r.doc_id: r.component_id for r in chosenpath.grouped(df, 4, exact=True).collect()} == want
    assert chosenpath.dedup(df, 4, exact=True).count() == len(rows) - len(pairs)


def test_near_dedup_keeps_columns_and_one_of_each_group(spark, rows):
    df = table(spark, rows)
    out = chosenpath.dedup(df, 5)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    want = {d for d, _, c, k in brute.near_components([r for i, r in enumerate(rows) if r not in rows[:i]], 5) if k}
    assert kept == want


def test_rows_of_one_id_and_sets_of_one_sum(spark, monkeypatch):
    text = lambda p: " ".join(f"{p}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("b") + " x"), (5, text("c")), (5, text("d")), (5, text("d")), (9, text("c")), (7, ""), (7, "")]
    df = table(spark, rows)
    got = sorted((r.doc_id or 0, (r.text or "")[:1]) for r in chosenpath.dedup(df, 5).collect())
    assert got == [(0, "a"), (0, "b"), (5, "c"), (5, "d"), (7, ""), (7, "")]
    seen, sets = chosenpath.classes(df, 5)
    one = sets.first().set_id
    made = spark.createDataFrame([(1, 1, 1, one, 10, 3, b"s"), (2, 2, 2, one, 11, 3, b"s"), (3, 3, 3, one, 10, 3, b"s")], "doc long, doc_id long, key long, set_id long, alt long, n long, sig binary")
    real = chosenpath.C.staged
    first = []
    monkeypatch.setattr(chosenpath.C, "staged", lambda d: real(made) if not first and (first.append(1) or True) else real(d))
    seen, sets = chosenpath.classes(df, 5)
    by = {r.doc: r.set_id for r in seen.collect()}
    assert by[1] == by[3] != by[2] and sets.count() == 2


def test_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, text), (7, text)], "doc_id long, text string")
    assert sorted(map(tuple, substringdedup.digest(df).select("doc_id", "n_removed").collect()), key=str) == [(7, 0), (None, 60)]
    assert {r.component_id for r in chosenpath.grouped(df, 4).collect()} == {7}
    empty = df.limit(0)
    assert suffixdedup.digest(empty).count() == substringdedup.digest(empty).count() == chosenpath.grouped(empty, 4).count() == 0


def test_runs_of_one_window_differ():
    """Texts of exactly one window that share their anchor only."""
    import numpy as np

    shared = 0
    for seed in range(50):
        a = np.random.default_rng(seed).integers(97, 123, 200).astype(np.uint8)
        b = a.copy()
        b[0] ^= 1
        x, y = (repeats.find_runs(t, np.array([0, 200]), 200, 32) for t in (a, b))
        assert x[3][0] != y[3][0] and repeats.find_runs(a.copy(), np.array([0, 200]), 200, 32)[3][0] == x[3][0]
        shared += int(x[2][0] == y[2][0])
    assert shared > 40


def test_given_documents_equal_plain_versions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, suffixdedup.digest(df).collect())) == sorted((d, *x) for (d, _), x in zip(rows, brute.byte_dedup([t for _, t in rows])))
    assert sorted(map(tuple, substringdedup.digest(df).collect())) == sorted(brute.word_dedup(rows))


def test_long_text_in_pieces(spark, monkeypatch):
    """Texts longer than a piece are read in overlapping pieces, and give the same rows."""
    rng = random.Random(3)
    passage = " ".join(f"s{rng.randint(0, 999)}" for _ in range(160))
    rows = [(i, " ".join(f"w{rng.randint(0, 99999)}" for _ in range(500)) + f" {passage} " + " ".join(f"v{rng.randint(0, 99999)}" for _ in range(500))) for i in range(3)]
    monkeypatch.setattr(repeats, "PIECE", 700)
    seen = []
    find = repeats.find_runs
    monkeypatch.setattr(repeats, "find_runs", lambda v, *a: seen.append(len(v)) or find(v, *a))
    for units, width, gram in ((suffixdedup.units, 200, 32), (substringdedup.units, 50, 8)):
        batch = [pa.RecordBatch.from_pydict({"key": [1, 2, 3], "doc": [0, 1, 2], "text": [t for _, t in rows]})]
        whole, starts = {}, {}
        for piece in (10**9, 700):
            monkeypatch.setattr(repeats, "PIECE", piece)
            covered = {}
            for out in repeats._runs(units, width, gram)(batch):
                for r in out.to_pylist():
                    for s in r["starts"]:
                        covered.setdefault(r["doc"], set()).update(range(s, s + r["size"]))
            whole[piece] = covered
        assert whole[10**9] == whole[700]  # every window lies in a run
    assert max(seen) > 5000 and sum(n <= 700 + 199 for n in seen) > 20
    monkeypatch.setattr(repeats, "PIECE", 700)
    batch = pa.RecordBatch.from_pydict({"key": [1], "doc": [0], "text": [rows[0][1]]})
    got = suffixdedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted((d, *x) for (d, _), x in zip(rows, brute.byte_dedup([t for _, t in rows])))
    assert batch.num_rows == 1


def test_texts_of_megabytes(spark):
    """Long texts that share long passages, one of them a single word."""
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**7)}" for _ in range(150_000)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:75_000] + [f"x{i}" for i in range(40_000)])), (3, "a" * 1_000_000), (4, "\n".join(base[100_000:]))]
    got = {r.doc_id: r for r in substringdedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_removed for i in (1, 2, 3, 4)] == [0, 75_000, 0, 50_000] and got[3].n_words == 1
    by = {r.doc_id: r for r in suffixdedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert by[3].n_removed == 1_000_000 and by[2].n_removed > 500_000
    near = {r.doc_id: r for r in chosenpath.grouped(spark.createDataFrame([*rows, (5, " ".join(base[:140_000]))], "doc_id long, text string"), 4).collect()}
    assert near[5].component_id == 1 and near[2].component_id == 2 and near[1].n_shingles == len({tuple(base[i : i + 4]) for i in range(len(base) - 3)})


def test_bucket_refinement_equals_sorting():
    import numpy as np

    rng = np.random.default_rng(5)
    raw = rng.integers(97, 99, 600).astype(np.uint8)
    raw[300:500] = raw[10:210]
    b = suffixdedup.buckets(raw, 50)
    text = raw.tobytes()
    seen = {}
    for i in range(len(raw) - 49):
        seen.setdefault(text[i : i + 50], []).append(i)
    for places in seen.values():
        ids = {b[i] for i in places}
        assert ids == {-1} if len(places) == 1 else len(ids) == 1 and -1 not in ids


def test_subtrees_split_by_longer_prefixes():
    import numpy as np

    rng = np.random.default_rng(6)
    v = rng.integers(0, 3, 900).astype(np.uint64)
    at = np.arange(0, 850)
    cls = {}
    for memory in (16_384, 16):
        groups = list(substringdedup.prefix_groups(v.astype(np.int64), at, 50, memory))
        assert sorted(np.concatenate([g for g, _ in groups]).tolist()) == list(range(850))
        cls[memory] = groups
    assert max(size for _, size in cls[16]) > 1
    v[400:470] = v[100:170]
    got = substringdedup.classes(v, np.array([0]), at)
    rows = {}
    for i in at:
        rows.setdefault(v[i : i + 50].tobytes(), set()).add(int(got[i]))
    assert all(len(x) == 1 for x in rows.values()) and len({next(iter(x)) for x in rows.values()}) == len(rows)


def test_internal_nodes_are_the_maximal_repeats():
    import numpy as np

    rng = np.random.default_rng(9)
    v = np.concatenate([rng.integers(0, 3, 60), [9], rng.integers(0, 3, 60)])
    v[70:95] = v[5:30]
    v[100:112] = v[10:22]
    n, width = len(v), 6
    order, depth = substringdedup.subtree(v, np.arange(n), n - np.arange(n))
    text = v.tolist()
    assert [text[i:] for i in order] == sorted(text[i:] for i in range(n))
    got = {(d, tuple(sorted(order[a:b].tolist()))) for a, b, d, _ in substringdedup.deep_nodes(depth, width)}
    want = set()
    for size in range(width, n):
        places = {}
        for i in range(n - size + 1):
            places.setdefault(tuple(text[i : i + size]), []).append(i)
        for at in places.values():  # repeats that no longer one holds at all its places
            if len(at) > 1 and len({text[i + size] if i + size < n else -1 - i for i in at}) > 1:
                want.add((size, tuple(at)))
    assert got == want and len(want) > 5
    nodes = substringdedup.deep_nodes(depth, width)
    assert all(p < 0 or nodes[p][0] <= a and b <= nodes[p][1] and nodes[p][2] < d for a, b, d, p in nodes)


@pytest.mark.parametrize("task_edges", [1_000_000, 40])
def test_components(spark, task_edges):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(500, 400), (500, 450)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long").repartition(3)
    assert {r.u: r.root for r in chosenpath.components(df, task_edges=task_edges).collect()} == {x: find(x) for x in up}
    assert chosenpath.components(df.limit(0)).count() == 0
