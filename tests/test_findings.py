"""Cases that a review found: each failed before its change."""

from pyspark.sql import functions as F

from ledgerlake.functions import landed


def test_digits_before_a_letter_are_no_day(spark):
    rows = [("https://h/a_150101x.xlsx", None), ("https://h/a_15012001x.xlsx", None), ("https://h/a_150101.xlsx", "2001-01-15"), ("https://h/a_15012001_x.xlsx", "2001-01-15")]
    got = spark.createDataFrame(rows, "url string, day string").select("day", landed.compact_day(F.col("url")).cast("string").alias("got")).collect()
    assert [r.got for r in got] == [r.day for r in got]


def test_counts_of_ways_equal_the_written_rows(spark):
    from ledgerlake.operators import matching

    labels = spark.createDataFrame([(i, "b", f"Alpha {'x' * (i % 3)} Fund", f"s{i}") for i in range(60)], "label_id long, block string, label string, shortcode string")
    master = spark.createDataFrame([(i, "b", f"Alpha {'x' * (i % 3)} Fund{' Growth' * (i % 2)}") for i in range(60)], "code long, block string, name string")
    short = spark.createDataFrame([("b", "S8", 8), ("b", "s16", 16)], "block string, key string, code long")
    rows = matching.cascade(labels, master, short, "block").groupBy("via").agg(F.count("*").alias("n")).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in matching.via_counts(labels, master, short, "block").collect()}
    assert dict(map(tuple, rows))["key_share"] > 1000


def test_copies_of_a_name_meet_once(spark):
    from ledgerlake.operators import matching

    n = 20_000  # all pairs of them: 400,000,000
    labels = spark.range(n).select(F.col("id").alias("label_id"), F.lit("b").alias("block"), F.lit("Alpha Fund").alias("label"))
    master = spark.range(n).select((F.col("id") + 7).alias("code"), F.lit("b").alias("block"), F.lit("alpha fund").alias("name"))
    got = matching.contained(labels, master, "block").agg(F.count("*").alias("n"), F.min("code").alias("a"), F.max("code").alias("b"), F.min("score").alias("s")).collect()
    assert [tuple(r) for r in got] == [(n, 7, 7, 100.0)]


def test_near_names_without_a_common_word_or_long_stretch(spark):
    from ledgerlake.functions import similarity
    from ledgerlake.operators import matching

    base = ["opportunitiesequity", "abcdefghijklmnopqrstuvwxyz", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "large and mid cap fund of growth", "one two three four five six seven"]
    other = ["oportunitiesequity", "abcdefghijklXmnopqrstuvwxyz", "aaaaaaaaaaaaabaaaaaaaaaaaaaaaaa", "large and mid cap fund of groth", "onne two three four five six seven", "seven six five four three two ane", "quite another name"]
    master = spark.createDataFrame([(i, "b", x) for i, x in enumerate(base)] + [(100 + i, "b", x) for i, x in enumerate(other)], "code long, block string, name string")
    got = {(r.code, r.sibling) for r in matching.near_copies(master, master.where("code < 100").select("code"), "block").collect()}
    want = {(100 + i, j) for i, x in enumerate(other) for j, y in enumerate(base) if similarity.token_sort(x.lower(), y) >= 94}
    assert got == want and len(want) >= 5


def test_a_best_match_scores_few_of_a_blocks_pairs(spark, monkeypatch):
    from functools import partial

    import pyarrow as pa

    from ledgerlake.functions import similarity
    from ledgerlake.operators import likeness

    left, right = [f"supplier {i * 13:09d}" for i in range(40)], [f"customer {i * 7:09d}" for i in range(500)]
    rows = [("b", 0, x, "", "", i, None, 0.0) for i, x in enumerate(left)] + [("b", 1, x, "", "", None, i, 0.0) for i, x in enumerate(right)]
    schema = pa.schema([("group", pa.string()), ("side", pa.int32()), ("norm", pa.string()), ("kind", pa.string()), ("years", pa.string()), ("left_rep", pa.int64()), ("right_rep", pa.int64()), ("less", pa.float64())])
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    calls, whole = [], similarity.token_set
    monkeypatch.setattr(similarity, "token_set", lambda a, b: calls.append(1) or whole(a, b))
    search = likeness._search("name", 40.0, partial(likeness._best, True), (pa.int64(), pa.int64()))
    got = {r["left_rep"]: (r["right_rep"], r["score"]) for out in search([batch]) for r in out.to_pylist()}
    assert len(got) == 40 and len(calls) < 0.1 * len(left) * len(right)
    for i in (0, 7, 39):
        want = min((-similarity.name_score(left[i], y), j) for j, y in enumerate(right))
        assert got[i] == (want[1], -want[0])


def test_likeness_by_tries_equals_plain_scores():
    import random

    import numpy as np

    from ledgerlake.functions import similarity
    from ledgerlake.operators import likeness

    rng = random.Random(3)

    def name():
        t = list(" ".join(rng.choice(("fund", "alpha", "beta", "growth", "a", "bb", "x" * 20)) for _ in range(rng.randint(0, 4))))
        for _ in range(rng.randint(0, 3) if t else 0):
            t[rng.randrange(len(t))] = rng.choice("abcxyz é😀")
        return " ".join("".join(t).split())

    for _ in range(5):
        a, b = [x for x in (name() for _ in range(12)) if len(x) <= likeness.BITS], [name() for _ in range(40)]
        left, right, less, own = likeness.Names(a), likeness.Names(b), np.array([rng.choice((0.0, 2.0)) for _ in b]), list(range(len(a)))
        assert likeness.partials(a[0], b).tolist() == [similarity.partial(a[0], y) for y in b]
        for cutoff in (-5.0, 60.0, 88.0, 94.0, 100.0):
            want = sorted((i, j, similarity.token_sort(a[i], b[j]) - less[j]) for i in own for j in range(len(b)) if similarity.token_sort(a[i], b[j]) - less[j] >= cutoff)
            assert sorted(likeness._pairs_by_trie(left, own, right, None, less, cutoff)) == want
            ranked = [min(((-(similarity.name_score(x, y) - less[j]), -len(y), j) for j, y in enumerate(b)), default=None) for x in a]
            best = likeness._best_by_trie(True, "name", left, own, right, lambda i: np.arange(len(b)), less, cutoff, list(range(len(b))))
            assert best == [(i, k[2], -k[0]) for i, k in enumerate(ranked) if -k[0] >= cutoff]


def test_variants_of_keys_over_a_million(spark):
    from types import SimpleNamespace

    from ledgerlake.plans import work

    keys = [3, 5, 6, 1_000_003, 1_000_005, 1_000_010, 1_000_012]
    part = spark.createDataFrame([(k, "b") for k in keys], "p_partkey long, p_brand string")
    got = {tuple(r) for r in work.near_copy_binding(SimpleNamespace(part=part)).collect()}
    assert got == {(k + 1_000_000, k, 95.0) for k in keys if k % 5 < 4}
    got = {tuple(r) for r in work.variant_siblings(SimpleNamespace(part=part)).collect()}
    assert got == {(k + 1_000_000, k, 100.0) for k in keys if k % 5 < 3}


def test_files_are_worked_out_once(spark):
    from ledgerlake.operators import families
    from ledgerlake.sources import workbook

    rows = [["Alpha Growth Fund"], ["PORTFOLIO STATEMENT AS ON : 31-Dec-2026"], ["Name of the Instrument", "ISIN", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"], ["Equity"], ["Acme Ltd", "INE000A01011", "10", "125", "12.5"]]
    book, made = workbook.book_bytes([("T1", rows)]), spark.sparkContext.accumulator(0)

    def files(batches):
        for b in batches:
            d = b.to_pandas()
            made.add(len(d))
            d["content"] = [None if i == 3 else b"no book" if i == 4 else book for i in d.pop("id")]
            yield __import__("pyarrow").RecordBatch.from_pandas(d, preserve_index=False)

    path = "concat(if(id = 5, '/landed/', '/landed/h/monthly/2026-12/'), id, '.xlsx') as path"
    landed = spark.range(0, 12, 1, 2).selectExpr("id", path).mapInArrow(files, "path string, content binary")
    houses = spark.createDataFrame([("h", "tab", False, True, True)], families.HOUSE)
    got = families.parse(landed, houses)
    assert {r.n_holdings for r in got.books.collect()} == {1} and got.books.count() == 9
    assert made.value == 12
    want = {("/landed/h/monthly/2026-12/3.xlsx", "it has no content"), ("/landed/h/monthly/2026-12/4.xlsx", "BadZipFile: File is not a zip file"), ("/landed/5.xlsx", "no house in its path")}
    assert {tuple(r) for r in got.rejected.collect()} == want and made.value == 24
    got.grid.unpersist()


def test_sheets_stream_through_the_parser(spark):
    from ledgerlake.operators import sheets

    rows = [["Name of the Instrument", "ISIN", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"], ["Equity"], ["Acme Ltd", "INE000A01011", "10", "125", None], None, ["Beta Ltd", "INE000A01012", "5", "75", "7.5"]]
    grid = spark.createDataFrame([(None if f == 2 else f"f{f}", f"s{s}", i, r) for f in range(3) for s in range(2) for i, r in reversed(list(enumerate(rows)))], "file string, sheet string, row_no int, cells array<string>")
    out = sheets.parse_tables(grid)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()
    got = {(r.file, r.sheet, r.ordinal, r.instrument, r.pct_nav, r.raw["isin"]) for r in out.collect()}
    assert got == {(f, s, k, n, w, i) for f in ("f0", "f1", None) for s in ("s0", "s1") for k, (n, w, i) in enumerate((("Acme Ltd", None, "INE000A01011"), ("Beta Ltd", "7.5", "INE000A01012")))}


def test_keys_of_small_blocks_meet_without_stretches(spark, monkeypatch):
    from ledgerlake.operators import matching

    monkeypatch.setattr(matching, "_every_piece", lambda *a: 1 / 0)
    labels = spark.createDataFrame([(1, 1, "alpha"), (2, 2, ""), (3, 3, "betagrowthfund"), (4, 3, "betagrow"), (5, None, "x"), (6, 4, "longlabel"), (7, 5, "alone")], "label_id long, block long, __a string")
    names = spark.createDataFrame([(10, 1, "alphafund"), (20, 2, "x"), (21, 2, ""), (30, 3, "betagrowth"), (31, 3, "x"), (50, None, "x"), (60, 4, "label")], "code long, block long, __b string")
    assert sorted(tuple(r) for r in matching.holding_pairs(labels, names, "block").collect()) == [(1, 10, 1), (3, 30, 3), (4, 30, 3)]
    assert (6, 60, 4) in {tuple(r) for r in matching.holding_pairs(labels, names, "block", 1).collect()}


def test_small_and_large_blocks_give_all_holding_pairs(spark):
    from ledgerlake.operators import matching

    a = [(100 * b + i, b, "fund" + "ab" * (i % 5) + str(i)[-1:] * (i % 3)) for b, n in ((1, 3), (2, 40), (3, 9)) for i in range(n)]
    b = [(100 * b + i, b, "fundab"[: i % 7] + "ab" * (i % 4) + "x" * (i % 2)) for b, n in ((1, 9), (2, 30), (3, 7)) for i in range(n)]
    got = matching.holding_pairs(spark.createDataFrame(a, "label_id long, block long, __a string"), spark.createDataFrame(b, "code long, block long, __b string"), "block", 5).collect()
    want = {(i, j, k) for i, k, x in a for j, m, y in b if k == m and (x and x in y or len(y) >= 5 and y in x)}
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 50 and {k for _, _, k in want} == {1, 2, 3}  # 27, 1,200 and 63 pairs


def test_stretches_at_a_texts_ends_are_scored_in_one_pass(monkeypatch):
    import random

    from ledgerlake.functions import similarity

    def plain(a, b):
        short, long = sorted((a, b), key=len)
        if not short:
            return 100.0 if not long else 0.0
        ways = [(short, long)] if len(a) != len(b) else [(a, b), (b, a)]
        return max(similarity.indel(x, y[max(0, i) : i + len(x)]) for x, y in ways for i in range(1 - len(x), len(y)))

    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcd é") for _ in range(r.randint(0, n)))
    for x, y in [(text(n), text(n)) for n in (3, 8, 20, 80) for _ in range(200)]:
        assert similarity.partial(x, y) == plain(x, y)
    calls, whole = [], similarity.indel
    monkeypatch.setattr(similarity, "indel", lambda a, b: calls.append(1) or whole(a, b))
    similarity.partial("fund advantage balanced abc", "abc balanced advantage fund")
    assert len(calls) == 0
    similarity.partial("abcdef" * 5, "fedcba" * 6)
    assert len(calls) <= 6


def test_containment_either_way_is_part_of_the_query(spark, tmp_path):
    import duckdb

    import __spark_entry__ as e

    rows = [(1, "Acme 2020 Fund", "b", "ETF"), (2, "acme fund", "b", "2021"), (3, "", "b", "x"), (4, None, "b", "x"), (5, "a&b", "b", "x"), (6, "A and B", "b", "x"), (7, "name of a fund", "c", "2020 2021"), (8, "long name of a fund", "c", None), (9, "acme fund", None, "x")]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = [tuple(r) for r in e.queries()["containment_match"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert sorted(got) == sorted(con.sql(e.oracle_sql()["containment_match"]).fetchall())
    found = {r[:2]: r[2:] for r in got}
    # equal keys; the closest name around the word; the name inside a label; structure apart
    assert found[6, "name"] == (5, 100.0) and found[2, "word"] == (2, 99 - 4 * 0.3) and found[7, "typed"] == (7, 99 - 8 * 0.2)
    assert (1, "typed") not in found and (3, "name") not in found and {x[1] for x in found.values()} - {100.0}


def test_no_step_of_the_cascade_is_broadcast(spark, monkeypatch):
    from ledgerlake.operators import matching

    plans, write = [], matching.staged
    monkeypatch.setattr(matching, "staged", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    monkeypatch.setattr(matching, "FEW_BLOCKS", 0, raising=False)
    rows = spark.range(12)
    labels = rows.selectExpr("id as label_id", "id as block", "case id % 3 when 0 then 'unlike' when 1 then 'alpha beta' else 'fund beta alpha' end as label", "concat('s', id) as shortcode")
    master = rows.selectExpr("id as code", "id as block", "'alpha beta fund' as name")
    out = matching.cascade(labels, master, rows.where("id % 3 = 0").selectExpr("id as block", "concat('S', id) as key", "id as code"), "block")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {(r.label_id, r.code, r.via) for r in out.collect()} == {(i, i, ("shortcode", "direct", "fuzzy")[i % 3]) for i in range(12)}
    assert len(plans) > 6 and sum("SortMergeJoin" in p for p in plans) > 4 and not any("Broadcast" in p for p in plans)
