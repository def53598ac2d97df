"""Family drivers, the workbook writer and reader, bounded likeness joins, vendor comparison: cases and plain versions."""

import random

import pytest

from ledgerlake.functions import similarity
from ledgerlake.operators import compare, families, likeness, matching
from ledgerlake.sources import workbook

HEADER = ["Name of the Instrument", "ISIN", "Industry", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"]


def rows(title, n, day="31-Dec-2025", coded=False):
    head = [HEADER[0], "", *HEADER[1:]] if coded else HEADER
    lines = [[f"Acme {i} Ltd", f"INE{i:09d}", "Trade", str(i + 1), "10.5", "5"] for i in range(n)]
    return [[title], [f"Portfolio statement as on {day}"], head, ["Equity"], *[[f"C{i}", *x] if coded else x for i, x in enumerate(lines)], ["GRAND TOTAL", "", "", "", "99", "100"]]


def parsed(spark, files, houses):
    df = spark.createDataFrame(files, "path string, content binary")
    return families.parse(df, spark.createDataFrame(houses, families.HOUSE))


def test_workbook_round_trip():
    grid = [["a", "", "<&>\"'"], [], ["x", 1.5, 7]]
    back = dict(workbook.sheets(workbook.book_bytes([("One & two", grid), ("Zwei", [["ü"] * 30])])))
    assert back["One & two"] == [["a", "", "<&>\"'"], [], ["x", "1.5", "7"]] and back["Zwei"] == [["ü"] * 30]


def test_families_of_houses(spark):
    book, archive = workbook.book_bytes, workbook.archive_bytes
    mega = [*[["SCHEME CODE 1 STARTS"], ["SCHEME: One Fund"]], *rows("x", 2)[1:], ["Details of default"], ["Name of the security"], ["Lost", "INE000000099", "", "1", "1", "1"], ["SCHEME CODE 2 STARTS"], ["Stray", "INE000000098", "", "1", "1", "1"], ["SCHEME: Two Fund"], *rows("x", 3, "30-Nov-2025")[1:]]
    files = [
        ("/l/plain/monthly/2025-12/Monthly Big Growth Fund 31 December 2025.xlsx", book([("Index", [["toc"]]), ("BGF", rows("BGF", 3)), ("Disclaimer text", [["x"]])])),
        ("/l/plain/fortnightly/2025-12-15/Only.xlsx", book([("index", rows("Nifty 50 Index Fund", 2))])),
        ("/l/plain/monthly/2025-12/pack.zip", archive([("All Schemes.xlsx", book([("AAA", rows("Alpha Fund", 9))])), ("b.xlsx", book([("Flexi Cap", [["AAA"], *rows("Alpha Fund", 2)]), ("AAA", rows("Alpha Fund", 4))])), ("Top 10 Holdings.xlsx", book([("ZZZ", rows("Z Fund", 9))]))])),
        ("/l/mega/monthly/2025-12/all.xlsx", book([("Sebi Exposure", mega)])),
        ("/l/mega/monthly/2025-12/none.xlsx", book([("S", rows("Unmarked Fund", 1))])),
        ("/l/cams/monthly/2025-12/DEBT_pack.xlsx", book([("Sheet", [["Scheme Name :", "Debt Fund"], *rows("y", 2, coded=True)[1:]]), ("notes", rows("n", 1))])),
        ("/l/coded/monthly/2025-12/c.xlsx", book([("Cover", rows("c", 1)), ("T1", rows("Coded Fund", 2, coded=True))])),
        ("/l/first/monthly/2025-12/f.xlsx", book([("A1X", rows("First Fund", 1)), ("B1X", rows("Second Fund", 1))])),
        ("/l/none/monthly/2025-12/n.xlsx", b"x"),
        ("/l/plain/monthly/2025-12/bad.xlsx", b"PK not a zip"),
        ("/l/plain/monthly/2025-12/null.xlsx", None),
        ("/l/odd/monthly/2025-12/o.xlsx", b"x"),
        ("/l/plain.xlsx", b"x"),
        ("/l/plain/monthly/2025-12/Holdings by issuer.xlsx", b"x"),
    ]
    houses = [("plain", "sebi_title", False, True, True), ("mega", "uti_mega", None, None, None), ("cams", "cams", None, True, True), ("coded", "tab_coded", None, True, True), ("first", "sebi_title", False, False, True), ("odd", "unheard", None, None, None)]
    got = parsed(spark, files, houses)
    books = {(b.house, b.scheme, b.shortcode, str(b.as_of), b.n_holdings, b.period) for b in got.books.collect()}
    assert books == {
        ("plain", "Big Growth Fund", "BGF", "2025-12-31", 3, "2025-12"),
        ("plain", "Nifty 50 Index Fund", None, "2025-12-31", 2, "2025-12-15"),
        ("plain", "Alpha Fund", "AAA", "2025-12-31", 4, "2025-12"),
        ("mega", "One Fund", None, "2025-12-31", 2, "2025-12"),
        ("mega", "Two Fund", None, "2025-11-30", 3, "2025-12"),
        ("mega", "Portfolio", None, "2025-12-31", 1, "2025-12"),
        ("cams", "Debt Fund", "DEBT", "2025-12-31", 2, "2025-12"),
        ("coded", "Coded Fund", "T1", "2025-12-31", 2, "2025-12"),
        ("first", "First Fund", "A1X", "2025-12-31", 1, "2025-12"),
    }
    coded = got.holdings.where("security_code is not null").select("instrument", "security_code").distinct().collect()
    assert {tuple(r) for r in coded} == {("Acme 0 Ltd", "C0"), ("Acme 1 Ltd", "C1")}
    assert {r.path.rsplit("/", 1)[1]: r.reason for r in got.rejected.collect()} == {"n.xlsx": "no driver for its house", "bad.xlsx": "BadZipFile: File is not a zip file", "null.xlsx": "it has no content", "o.xlsx": "its house's family is unknown", "plain.xlsx": "no house in its path", "Holdings by issuer.xlsx": "a marketing pack"}
    got.grid.unpersist()


def test_families_of_nothing(spark):
    got = parsed(spark, [], [("plain", "sebi_title", False, True, True)])
    assert got.books.count() == got.holdings.count() == got.rejected.count() == 0


# ---------------------------------------------------------------- likeness


def some_names(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "beta", "growth", "fund", "large", "cap", "mid", "index", "nifty", "50", "debt", "etf", "fof", "2027", "2030", "of", "funds", "x", "équité"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 7))) + rng.choice(["", "s", " -", "q"]) for _ in range(n)]


def plain_conflict(a, b):
    import re

    years = [set(re.findall(r"\b(20\d\d)\b", x)) for x in (a, b)]
    etf, fof = ([bool(re.search(p, x, re.I)) for x in (a, b)] for p in (r"\betf\b|exchange traded", r"\bfof\b|fund of funds"))
    return bool(years[0] and years[1] and not years[0] & years[1]) or fof[0] != fof[1] or (etf[0] != etf[1] and not fof[0])


@pytest.mark.parametrize("sizes", [{}, {"chunk": 3, "part": 5}])
def test_best_alike_equals_all_pairs(spark, sizes):
    left = [(i, f"b{i % 3}", x) for i, x in enumerate(some_names(1, 60))] + [(90, "b0", None), (91, None, "alpha fund")]
    right = [(1000 + i, f"b{i % 3}", x, 2.0 * (i % 2)) for i, x in enumerate(some_names(2, 70))]
    norm = {r[0]: r.n for r in spark.createDataFrame([(i, n) for i, _, n in left] + [(i, n) for i, _, n, _ in right], "id long, name string").selectExpr("id", "name").withColumn("n", likeness.text.norm_text(likeness.F.coalesce("name", likeness.F.lit("")))).collect()}
    ldf, rdf = spark.createDataFrame(left, "id long, block string, name string"), spark.createDataFrame(right, "id long, block string, name string, less double")
    for strict, cutoff in ((True, 55.0), (False, -100.0)):
        got = {r.id: (r.other, round(r.score, 9)) for r in likeness.best_alike(ldf, rdf, "block", cutoff, strict=strict, **sizes).collect()}
        want = {}
        for i, b, x in left:
            fit = [(-(similarity.name_score(norm[i], norm[j]) - less), -len(norm[j]), j) for j, c, y, less in right if b is not None and b == c and not (strict and plain_conflict(x or "", y))]
            fit = [f for f in fit if -f[0] >= cutoff]
            if fit:
                want[i] = (min(fit)[2], round(-min(fit)[0], 9))
        assert got == want
    got = {(r.id, r.other): round(r.score, 9) for r in likeness.alike_pairs(ldf, rdf.drop("less"), "block", 70.0, **sizes).collect()}
    assert got == {(i, j): round(s, 9) for i, b, _ in left for j, c, _, _ in right if b is not None and b == c and (s := similarity.token_sort(norm[i], norm[j])) >= 70}


def test_bounds_hold():
    import numpy as np

    texts = [" ".join(x.split()) for x in some_names(3, 120)]
    a = likeness.Names(texts)
    at = np.arange(len(texts))
    for i in range(len(texts)):
        for kind, plain in (("sort", similarity.token_sort), ("name", similarity.name_score)):
            m = likeness.MEASURES[kind]
            score = np.array([plain(texts[i], t) for t in texts])
            bound, rough = m.bound(a, i, a, at), m.rough(a, i, a, at)
            assert (bound >= score - 1e-9).all() and (rough >= score - 1e-9).all()


def test_fuzzy_and_new_parents_equal_all_pairs(spark):
    labels = [(i, "b", x) for i, x in enumerate(some_names(5, 40))]
    master = [(i, "b", x) for i, x in enumerate(some_names(6, 40))]
    ldf, mdf = spark.createDataFrame(labels, "label_id long, block string, label string"), spark.createDataFrame(master, "code long, block string, name string")
    got = {r.label_id: round(r.score, 6) for r in matching.fuzzy(ldf, mdf, "block", 60.0).collect()}
    norm = lambda s: r if (r := spark.range(1).select(likeness.text.norm_text(likeness.F.lit(s))).first()[0]) else ""
    known = {x: norm(x) for _, _, x in labels + master}
    want = {}
    for i, _, x in labels:
        fit = [similarity.name_score(known[x], known[y]) for _, _, y in master if not plain_conflict(x, y)]
        if fit and max(fit) >= 60:
            want[i] = round(max(fit), 6)
    assert got == want
    out = {r.code: (r.label_id, r.action) for r in matching.new_parents(mdf, mdf.where("code < 5"), ldf, ldf.where("label_id % 2 = 0"), "block").collect()}
    for i, _, y in master[5:]:
        best = min((-(similarity.name_score(known[x], known[y]) - 2 * (j % 2 == 0)), j) for j, _, x in labels)
        assert out[i] == (best[1], "bind" if -best[0] >= 95 else "review" if -best[0] >= 90 else "add")


def test_vendor_compare_is_one_to_one(spark):
    ours = [("b1", 1, "Acme Ltd", 5.0), ("b1", 2, "Acme Ltd", 4.0), ("b1", 3, "Acme Limited Co", 3.0), ("b1", 4, "Ltd Beta", None), ("b1", 5, None, 1.0), ("b2", 6, "Gamma", 1.0), ("b2", 7, "Delta Bank", 10.0)]
    theirs = [("b1", 11, "ACME LTD", 5.1), ("b1", 12, "Acme Ltds", 9.0), ("b1", 13, "Acme Ltdss", 4.0), ("b1", 14, "Beta Ltd", 7.0), ("b2", 15, "Other", 0.01), ("b2", 16, "Another one", 2.0), ("b2", 17, "Delta Bnk", 11.0)]
    schema = "book string, id long, name string, weight double"
    out = compare.vendor_compare(spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema), "book")
    got = {(r.ours, r.theirs, r.status) for r in out.collect()}
    assert got == {(1, 11, "match"), (2, 12, "off"), (3, None, "ours_only"), (4, 14, "match"), (None, 13, "theirs_only"), (6, None, "ours_only"), (7, 17, "match"), (None, 15, "negligible"), (None, 16, "theirs_only")}
    used = [r.theirs for r in out.collect() if r.theirs is not None]
    assert len(used) == len(set(used))


def vendor_rows(seed=8, books=40):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gama", "delta", "epsilon", "zeta", "bank", "power", "steel", "works"]
    sides = []
    for first in (0, 1):
        rows = []
        for i in range(books * 6):
            name = " ".join(rng.sample(words, rng.randint(2, 4)))
            if rng.random() < 0.4:
                name = name[1:] if rng.random() < 0.5 else name + "s"
            name = rng.choice([name, name.upper(), name, name, None if rng.random() < 0.1 else name])
            book = None if rng.random() < 0.03 else f"b{rng.randrange(books) if rng.random() < 0.8 else 0}"
            rows.append((book, 2 * i + first, name, None if rng.random() < 0.1 else rng.choice([0.01, 1.0, 5.0, 9.0])))
        sides.append(rows)
    return sides


def test_vendor_compare_in_small_and_large_books(spark):
    from ledgerlake.functions import similarity

    ours, theirs = vendor_rows()
    norm = {n: n.lower() for _, _, n, _ in ours + theirs if n}
    pairs = {}
    for b in {r[0] for r in ours} - {None}:
        a, o = ([r for r in rows if r[0] == b and r[2]] for rows in (ours, theirs))
        nth = lambda rows: {(norm[r[2]], sum(q[1] < r[1] and norm[q[2]] == norm[r[2]] for q in rows)): r[1] for r in rows}
        x, y = nth(a), nth(o)
        pairs |= {x[k]: (y[k], 100.0) for k in x if k in y}
        edges = [(-similarity.token_sort(norm[r[2]], norm[q[2]]), r[1], q[1]) for r in a for q in o if r[1] not in pairs and q[1] not in {y[k] for k in x if k in y}]
        used = set()
        for s, i, j in sorted(e for e in edges if e[0] <= -88):
            if i not in pairs and j not in used:
                used.add(j)
                pairs[i] = (j, -s)
    taken = {j for j, _ in pairs.values()}
    want = {(r[1], *pairs.get(r[1], (None, None))) for r in ours if r[2]} | {(None, r[1], None) for r in theirs if r[2] and r[1] not in taken}
    assert sum(1 for _, s in pairs.values() if s < 100) > 5
    schema = "book string, id long, name string, weight double"
    x, y = spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema)
    seen = []
    for most in (1000, 20, 0):
        rows = compare.vendor_compare(x, y, "book", most=most).collect()
        assert len(rows) == len(want) and {(r.ours, r.theirs, r.score) for r in rows} == want
        seen.append(sorted(map(str, rows)))
    assert seen[0] == seen[1] == seen[2]


def test_likeness_of_few_texts():
    from ledgerlake.functions import similarity
    from ledgerlake.operators.likeness import alike_texts

    rng = random.Random(1)
    words = ["almond", "antique", "blue", "steel", "copper", "series", "1", "2", "polished", "brushed", "x" * 20]
    for k in range(400):
        left = [" ".join(rng.sample(words, rng.randint(1, 9))) for _ in range(3 if k % 8 else 15)]
        right = [x[1:] if rng.random() < 0.3 else x + "s" * rng.randint(0, 9) for x in left] + ["a"]
        cutoff = rng.choice([50.0, 88.0, 95.0, 100.0])
        want = [(i, j, s) for i, x in enumerate(left) for j, y in enumerate(right) if (s := similarity.token_sort(x, y)) >= cutoff]
        assert sorted(alike_texts(left, right, cutoff)) == want
    assert alike_texts([], ["a"], 88.0) == []


def test_vendor_compare_deals_names_once(spark, monkeypatch):
    plans, real = [], getattr(compare, "staged", None)
    monkeypatch.setattr(compare, "staged", lambda d: plans.append(d) or real(d), raising=False)
    ours, theirs = vendor_rows()
    schema = "book string, id long, name string, weight double"
    plans.append(compare.vendor_compare(spark.createDataFrame(ours, schema), spark.createDataFrame(theirs, schema), "book"))
    assert sum(d._jdf.queryExecution().executedPlan().toString().count("Exchange ") for d in plans) == 1


# ---------------------------------------------------------------- headers and index sheets


def test_universal_headers_equal_ordered_patterns(spark):
    import re

    from ledgerlake.functions import headers

    rng = random.Random(4)
    bits = ["Name of the", "Security", "code", "ISIN", "yield", "to maturity", "maturity", "date", "Market", "value", "(Rs in lakh)", "% to", "NAV", "rating", "industry /", "sector", "units", "price", "qty", "_x000d_", "\n", "null", "col_2", "", "top 10 issuers", "remarks:", "*", "scheme", "duration"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 4))) for _ in range(400)] + [None, "SR", "col"]

    def plain(h):
        t = re.sub(r"\s+", " ", (h or "").replace("\r", " ").replace("\n", " ").replace("_x000d_", " ").replace("_x000a_", " ")).strip().strip(".:*|")
        if not t or re.fullmatch(r"(?i)col(_\d+)?", t) or t.lower() == "null":
            return "blank"
        return "ignore" if re.search(headers.IGNORED, t, re.I) else next((k for k, p in headers.UNIVERSAL.items() if re.search(p, t, re.I)), "unmapped")

    got = spark.createDataFrame([(x,) for x in texts], "h string").withColumn("f", headers.universal_field(likeness.F.col("h"))).collect()
    assert [r.f for r in got] == [plain(x) for x in texts]


def test_legacy_names_number_what_recurs(spark):
    from ledgerlake.functions import headers

    rows = [(["ISIN", "isin code", "Qty", "", " ", "Other", "Other", "Other", "Sector"],), ([],)]
    got = [r.n for r in spark.createDataFrame(rows, "h array<string>").select(headers.legacy_names(likeness.F.col("h")).alias("n")).collect()]
    assert got == [["isin", "isin code", "quantity", "col", "col_2", "Other", "Other_2", "Other_3", "industry"], []]


GRID = "file string, sheet string, row_no int, cells array<string>"


def test_index_pairs(spark):
    from ledgerlake.operators import indexes

    sheets = {
        "a": [["Contents"], ["Fund ID", "Click", "Scheme Name", "Short Name"], ["12", "", "  One   Fund", "ONE"], ["13", "", "Two Fund", ""], ["", "", "No code", "X"], ["Fund Code", "", "Scheme Name", ""], ["T3", "", "Three Fund", "THREE"], ["9"], [None, None, None, None]],
        "b": [["Short name", "Scheme name"], ["B1", "B One"]],
        "c": [["nothing", "here"], ["x", "y"]],
    }
    grid = spark.createDataFrame([(f, "Index", i, c) for f, rows in sheets.items() for i, c in enumerate(rows)], GRID)
    assert {(r.file, r.code, r.name) for r in indexes.index_pairs(grid).collect()} == {("a", "ONE", "One Fund"), ("a", "13", "Two Fund"), ("a", "T3", "Three Fund"), ("b", "B1", "B One")}
    assert indexes.index_pairs(grid.limit(0)).count() == 0


def test_scheme_rows(spark):
    from ledgerlake.operators import indexes

    sheets = {
        ("/x/Some Pack.xlsx", "S/1"): [["title"], ["Fund", "Security", "Qty", "Market value"], ["Alpha: Fund", "A", "1", "2"], ["", "B", "3", "4"], ["Total", "", "7", ""], [], ["-", "total"], ["Beta Fund", "C"], ["x", "INE000A01011"]],
        ("/x/Other.xlsx", "Tab"): [["Security", "Rating"], ["D", "AAA"], ["E", "AA", "ignored"]],
        ("/x/None.xlsx", "Tab"): [["a", "b"]],
    }
    grid = spark.createDataFrame([(f, s, i, c) for (f, s), rows in sheets.items() for i, c in enumerate(rows)], GRID)
    got = {(r.scheme, r.row_no, tuple(sorted(r.fields.items()))) for r in indexes.scheme_rows(grid).collect()}
    assert {(s, n) for s, n, _ in got} == {("Alpha_ Fund", 2), ("Some Pack", 3), ("x", 8)}
    assert ("Alpha_ Fund", 2, (("Fund", "Alpha: Fund"), ("instrument", "A"), ("market_value", "2"), ("quantity", "1"))) in got


# ---------------------------------------------------------------- sources


def test_listing_source_plans_only_wanted_files(spark, tmp_path):
    import json

    from pyspark.sql.datasource import EqualTo, In, StringContains

    from ledgerlake.sources import plugin

    for house in ("a", "b"):
        for period in ("2026-01", "2026-02"):
            d = tmp_path / f"house={house}" / "cadence=monthly" / f"period={period}"
            d.mkdir(parents=True)
            (d / "l.json").write_text("\n".join(json.dumps(r) for r in [{"ordinal": 1, "url": f"u-{house}-{period}", "extra": 3}, {"ordinal": 2, "title": "no address"}, {"ordinal": 3, "url": "", "title": "empty"}]))
            (d / "_SUCCESS").write_text("")
    (tmp_path / "loose.json").write_text("")
    source = plugin.ListingSource({"path": f"file://{tmp_path}"})
    reader = source.reader(None)
    assert len(reader.partitions()) == 5
    title = StringContains(("title",), "x")
    assert list(reader.pushFilters([EqualTo(("house",), "a"), In(("period",), ("2026-02", "2026-03")), title])) == [title]
    assert [p.keys for p in reader.partitions()] == [{"house": "a", "cadence": "monthly", "period": "2026-02"}]
    plugin.register(spark)
    df = spark.read.format("ledger_listing").load(f"file://{tmp_path}")
    assert {r.url for r in df.collect()} == {f"u-{h}-{p}" for h in "ab" for p in ("2026-01", "2026-02")}
    assert [r.url for r in df.where("period > '2026-01' and house <=> 'b'").collect()] == ["u-b-2026-02"]


def test_versions_survive_crashes_and_conflicts(spark, tmp_path):
    from ledgerlake.sources import manifest

    root = f"file://{tmp_path}/store"
    assert manifest.versions(spark, root) == [] and manifest.pinned(spark, root) == {}
    one = spark.range(3)
    assert manifest.publish({"t": one}, root) == 1
    held = manifest.pinned(spark, root)["t"]
    manifest.stage({"t": spark.range(9)}, root)  # a crash before the commit
    assert manifest.pinned(spark, root)["t"].count() == 3
    slow = manifest.stage({"t": spark.range(5)}, root)
    assert manifest.commit(spark, root, manifest.stage({"u": spark.range(7)}, root), after=1) == 2
    with pytest.raises(manifest.Conflict):
        manifest.commit(spark, root, slow, after=1)
    now = manifest.pinned(spark, root)
    assert now["t"].count() == 3 and now["u"].count() == 7 and held.count() == 3
    assert manifest.publish({"t": now["t"].union(spark.range(1))}, root) == 3 and manifest.pinned(spark, root)["t"].count() == 4
    assert manifest.pinned(spark, root, 1)["t"].count() == 3
    assert manifest.expire(spark, root, 1) == 2 and manifest.versions(spark, root) == [3]
    assert manifest.pinned(spark, root)["t"].count() == 4 and manifest.pinned(spark, root)["u"].count() == 7


def test_missing_lists_come_from_gaps(spark):
    funds = spark.createDataFrame([(k,) for k in range(0, 400, 3)] + [(3,)], "k long")
    rng = random.Random(1)
    held = sorted({(rng.randrange(0, 400, 3), y) for y in (2020, 2021, 2022) for _ in range((y - 2019) * 60)} | {(1, 2020)} | {(k, 2030) for k in range(0, 400, 3)})
    got = {(r.y, r.k): r["rank"] for r in compare.missing_list(funds, spark.createDataFrame(held, "k long, y int"), "k", "y", 20).collect()}
    want = {}
    for y in {y for _, y in held}:
        lack = [k for k in range(0, 400, 3) if (k, y) not in set(held)][:20]
        want |= {(y, k): i + 1 for i, k in enumerate(lack)}
    assert got == want


def test_rollups_and_phantom_runs(spark):
    from ledgerlake.operators import guards, rollups

    rows = spark.createDataFrame([("a", "2026-01-05", "x"), ("a", "2026-01-05", "y"), ("a", "2026-02-01", "x"), ("a", None, "z"), ("b", "2026-02-03", None)], "k string, d string, c string").selectExpr("k", "date(d) d", "c")
    period = rollups.F.trunc("d", "MM")
    held = rollups.states(rows.where("c <> 'y' or c is null"), ["k"], period, "d", "c")
    late = rollups.states(rows.where("d < date'2026-02-01'"), ["k"], period, "d", "c")
    got = {r.k: (r.n, str(r["first"]), str(r["last"]), r.days, r.codes) for r in rollups.merged(rollups.refreshed(held, late), ["k"]).collect()}
    assert got == {"a": (4, "2026-01-05", "2026-02-01", 2, 3), "b": (1, "2026-02-03", "2026-02-03", 1, 0)}
    assert [r.c for r in rollups.most_common(rows, "c", 2).collect()] == ["x", "y"]
    filings = spark.createDataFrame([(1, "2026-03-01", k, "2026-03-01" if k < 19 else None) for k in range(20)] + [(2, "2026-03-02", k, "2026-03-02") for k in range(5)] + [(3, "2026-03-03", k, "2026-02-28") for k in range(30)], "run_id int, run_day string, key long, as_of string")
    assert {r.run_id: r.phantom for r in guards.stamped_runs(filings).collect()} == {1: True, 2: False, 3: False}
    books = spark.createDataFrame([(4, "2026-03-01"), (4, "2026-03-01")], "key long, as_of string")
    kept = guards.without_stamps(filings, books).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in kept} == {1: 2, 2: 5, 3: 30}
