import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import books, catalog, compare, guards, listings, matching, picks, sheets
from ledgerlake.sources import bookstore, pages, schememaster, workbook

BOOK = "book string, ordinal int, instrument string, section string, isin string, quantity double, market_value double, pct_nav double, stated_total double"


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_normalize_steps_in_order(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "Acme Ltd", "Equity", "INE1", 1.0, 60.0, 0.60, 100.0),
            ("a", 2, "TREPS", "Cash", None, None, 37.0, 0.37, 100.0),
            ("a", 3, "Net Receivables", "Cash", None, None, 1.0, 0.01, 100.0),
            ("a", 4, "Net Receivables", "Cash", None, None, 2.8, 0.028, 100.0),
            ("b", 1, "Junk Ltd", "Equity", "INE2", 300.0, 0.0, 0.0, None),
            ("b", 2, "Junk 2 Ltd", "Equity", "INE3", -100.0, None, None, None),
        ],
        BOOK,
    )
    out = {(r.book, r.ordinal): r for r in books.normalize(df).collect()}
    assert ("a", 3) not in out  # the earlier of two equal lines
    assert out["a", 4].instrument == "Cash" and abs(out["a", 4].pct_nav - 3.0) < 1e-6  # fraction to percent, then the residual
    assert abs(out["b", 1].pct_nav - 75) < 1e-9 and abs(out["b", 2].market_value - 1.0) < 1e-9
    again = books.normalize(books.normalize(df))
    assert sorted(rows(again, "book", "ordinal")) == sorted(out)


def test_drop_rollup_needs_two_kinds_with_receivables(spark):
    df = spark.createDataFrame([("x", 1, "sum", 5.0, None), ("x", 2, "c", 3.0, "cash"), ("x", 3, "r", 2.0, "receivables"), ("y", 1, "sum", 5.0, None), ("y", 2, "c", 3.0, "cash"), ("y", 3, "d", 2.0, "cash")], "b string, n int, name string, w double, kind string")
    out = books.drop_rollup(df, "b", "w", F.col("name") == "sum", F.col("kind"), "receivables", 0.05)
    assert sorted(rows(out, "b", "n")) == [("x", 2), ("x", 3), ("y", 1), ("y", 2), ("y", 3)]


def test_publish_fields_and_types(spark):
    raw = spark.createDataFrame([("b", " Acme Ltd ", "INE000A01010", "Banks", "CRISIL AAA", None, "Equity", "1,000", "2500000000", "-", "", "", "", "", "")], "book string, instrument string, isin string, industry string, industry_rating string, rating string, section string, quantity string, market_value string, pct_nav string, coupon string, ytm string, ytc string, instrument_yield string, maturity_date string")
    r = books.publish(raw).first()
    assert len(r) == 18 and r.instrument == "Acme Ltd" and r.holding_type == "equity" and r.market_value == 25000.0 and r.pct_nav == 100.0 and r.rating == "CRISIL AAA" and r.maturity_date is None


def test_ties(spark):
    df = spark.createDataFrame([("k", 5, 1), ("k", 5, 2), (None, 1, 3)], "k string, n int, o int")
    assert sorted(r.o for r in picks.keep_richest(df, "k", "n", "o", False).collect()) == [1, 3]
    assert sorted(r.o for r in picks.keep_richest(df, "k", "n", "o", True).collect()) == [2, 3]
    m = picks.mode_of(spark.createDataFrame([("g", "b"), ("g", "a")], "g string, v string"), "g", "v").first()
    assert m.v == "a"


def test_phantom_dates_and_availability(spark):
    adv = spark.createDataFrame([("1", "2026-08-15"), ("1", "2026-08-31"), ("2", "2026-08-31")], "portfolio_id string, as_of string").withColumn("as_of", F.to_date("as_of"))
    have = adv.where("not (portfolio_id = '1' and as_of = '2026-08-31')")
    assert guards.phantom_dates(adv, have, ["portfolio_id", "as_of"]).count() == 1
    assert {r.portfolio_id: len(r.available_as_of) for r in catalog.availability(adv, have).collect()} == {"1": 1, "2": 1}
    with pytest.raises(ValueError):
        guards.require_none(guards.phantom_dates(adv, have, ["portfolio_id", "as_of"]), "phantom dates")


def test_api_decisions(spark):
    cat = spark.createDataFrame([("100001", "100001", "2026-08-31"), ("100002", None, None)], "code string, portfolio_id string, latest_as_of string").withColumn("latest_as_of", F.to_date("latest_as_of"))
    store = spark.createDataFrame([("100001", "2026-08-31", ["h"]), ("100001", "2026-07-31", ["g"])], "portfolio_id string, as_of string, holdings array<string>").withColumn("as_of", F.to_date("as_of"))
    ask = lambda *a: catalog.holdings_as_of(cat, store, *a).first()
    r = ask("100001")
    assert (r.status, r.holdings, r.previous_exists, r.next_exists) == (200, ["h"], True, False)
    assert ask("100001", "2026-06-30").status == 404 and ask("100001", "2026-07").status == 200
    assert ask("100001", "junk").status == 400 and ask("12", None).status == 400
    assert ask("100002").status == 404 and ask("999999").message == "Unknown code"


def test_cascade(spark):
    labels = spark.createDataFrame([(1, "A", "Acme Liquid Fund", "AL"), (2, "A", "Acme Liquid Funds Regular", "zz"), (3, "A", "Acme Corporate Bnd", None), (4, "B", "Other", None)], "label_id int, block string, label string, shortcode string")
    master = spark.createDataFrame([("m1", "A", "Acme Liquid Fund"), ("m2", "A", "Acme Corporate Bond"), ("m3", "B", "Nothing Alike Here")], "code string, block string, name string")
    short = spark.createDataFrame([("A", "al", "m1")], "block string, key string, code string")
    got = {r.label_id: (r.code, r.via) for r in matching.cascade(labels, master, short, "block").collect()}
    assert got[1] == ("m1", "shortcode") and got[3] == ("m2", "fuzzy") and 4 not in got


def test_sheet_parser(spark):
    grid = [
        ["Acme fund: suitable for investors who are seeking market instruments"],
        ["Sr No", "Name of the Instrument", "ISIN", "Quantity", "Market Value (Rs lakh)", "% to NAV"],
        ["Equity & Equity related"],
        ["1", "Alpha Ltd", "INE000A01010", "10", "60", "60.0"],
        ["2", "Beta Ltd", "INE000B01010", "5", "30", "30.0"],
        ["Sub Total", "", "", "", "90", "90.0"],
        ["Cash"],
        ["", "TREPS", "", "", "10", "*"],
        ["Grand Total", "", "", "", "100", "100"],
        ["3", "Annex Ltd", "INE000C01010", "1", "1", "1"],
    ]
    df = spark.createDataFrame([("f", 0, "s", i, c) for i, c in enumerate(grid)], "file string, sheet_no int, sheet string, row_no int, cells array<string>")
    head = sheets.header_rows(df, ["file", "sheet"], "row_no", sheets.header_score(F.col("cells"))).first()
    assert head.header_row == 1
    got = sheets.parse_tables(df).orderBy("ordinal").collect()
    assert [(r.instrument, r.section, r.pct_nav, r.implied) for r in got] == [("Alpha Ltd", "Equity & Equity related", "60.0", False), ("Beta Ltd", "Equity & Equity related", "30.0", False), ("TREPS", "Cash", "10", True)]
    assert sheets.alias_headers(["ISIN", "ISIN code", "x", "x"]) == ["isin", "isin_code", "x", "x_2"]


def _xlsx(rows):
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + k)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{chr(65 + k)}{i}"><v>{v}</v></c>' for k, v in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(_xlsx([["x", 1.0], ["y", 2.5]]))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("d/a.xlsx", _xlsx([["z"]]))
        z.writestr("e/a.xlsx", _xlsx([["w"]]))
        z.writestr("__MACOSX/a.xlsx", b"no")
    (tmp_path / "bad.xlsx").write_bytes(b"PK\3\4 cut off")
    grid, bad = workbook.read(spark, f"file://{tmp_path}")
    cells = sorted((r.file.rsplit("/", 1)[-1], r.row_no, tuple(r.cells)) for r in grid.collect())
    assert cells == [("a.xlsx", 0, ("x", "1")), ("a.xlsx", 1, ("y", "2.5")), ("b.zip!a.xlsx", 0, ("z",)), ("b.zip!a_2.xlsx", 0, ("w",))]
    assert bad.count() == 1
    raw = spark.read.format("binaryFile").load(f"file://{tmp_path}")
    got = {r.path.rsplit("/", 1)[-1]: (r.kind, r.whole) for r in raw.select("path", workbook.file_kind(F.col("content")).alias("kind"), workbook.is_complete(F.col("content")).alias("whole")).collect()}
    assert got == {"a.xlsx": ("zip", True), "b.zip": ("zip", True), "bad.xlsx": ("zip", False)}
    assert workbook.zip_problem(b"") and not workbook.zip_problem(_xlsx([["q"]]))


def test_scheme_master(spark, tmp_path):
    (tmp_path / "nav.txt").write_text("Open Ended Schemes(Debt)\n\nAcme Mutual Fund\n\n100001;INF1;-;Acme Liquid - Direct - Growth;10.5;31-Aug-2026\n100002;INF2;;Acme Gilt;N.A.;31-Aug-2026\nBeta Mutual Fund\n100003;INF3;;Beta;1;bad\n")
    (tmp_path / "old.txt").write_text("Scheme Code;Scheme Name;Plan;Option;ISIN 1;ISIN 2;NAV;Date\nAcme Mutual Fund\n100009;Acme;Direct;Growth;INF9;;11.0;15-Aug-2026\n")
    got = {r.code: r for r in schememaster.parse(schememaster.lines(spark, f"file://{tmp_path}")).collect()}
    assert got["100001"].amc == "Acme Mutual Fund" and got["100001"].category.startswith("Open") and got["100001"].isin_reinvest is None
    assert str(got["100001"].nav_date) == "2026-08-31" and got["100002"].nav is None and got["100003"].amc == "Beta Mutual Fund" and got["100003"].nav_date is None
    assert got["100009"].plan == "Direct" and got["100009"].isin == "INF9" and got["100009"].nav == "11.0"
    assert guards.swapped_columns(spark.createDataFrame([("INF123456789", "INF1"), ("10.5", "INF2")], "nav string, isin string")).count() == 1


def test_pages(spark):
    html = "<h2>Year 2025</h2><a href='/a b.xlsx'>A &amp; B</a><h3>2026</h3><a class=x href=\"c.xlsx\"><b>C</b></a><script>const files = [{\"u\": \"/d.zip\"}];</script>"
    df = spark.createDataFrame([(1, "https://h.org/dir/page?x=1", html)], "page_id int, url string, html string")
    assert rows(pages.links_with_year(df).orderBy("pos"), "year", "label") == [("2025", "A & B"), ("2026", "C")]
    got = df.select(pages.assets(F.col("html")).alias("a"), pages.embedded_json(F.col("html"), "files").alias("j"), pages.absolute(F.col("url"), F.lit("/a b.xlsx")).alias("u"), pages.absolute(F.col("url"), F.lit("c.xlsx")).alias("v")).first()
    assert got.a == ["/d.zip"] and got.j == '[{"u": "/d.zip"}]' and got.u == "https://h.org/a%20b.xlsx" and got.v == "https://h.org/dir/c.xlsx"


def test_listing_policies(spark):
    df = spark.createDataFrame([(1, 0, "http://x/p_Aug_2026.xlsx", "Monthly portfolio Aug 2026"), (1, 1, "http://x/q.xlsx", "Fortnightly portfolio Aug 2026"), (1, 2, "http://x/z_final.xlsx", "Final monthly portfolio Aug 2026"), (1, 3, "http://x/2026/7/u.xlsx", "Monthly")], "amc_id int, ordinal int, url string, title string")
    pick = lambda k: sorted(r.ordinal for r in listings.select(df, listings.POLICIES[k]).collect())
    assert pick("first_per_month") == [0, 3] and pick("last_per_month") == [2, 3] and pick("final_first") == [2, 3]
    assert pick("fortnightly_only") == [1] and pick("monthly_only") == [0, 2, 3] and pick("greatest_url") == [2, 3]


def test_bookstore_round_trip(spark, tmp_path):
    h = spark.createDataFrame([("1", "2026-08-31", "monthly", 1, "B"), ("1", "2026-08-31", "monthly", 0, "A"), ("2", "2026-07-31", "monthly", 0, "C")], "portfolio_id string, as_of string, cadence string, ordinal int, instrument string").withColumn("as_of", F.to_date("as_of"))
    for f in bookstore.HOLDING:
        if f.name != "instrument":
            h = h.withColumn(f.name, F.lit(None).cast(f.dataType))
    path = f"file://{tmp_path}/store"
    bookstore.write(bookstore.nest(h), path)
    new = bookstore.nest(h.where("portfolio_id = '2'").withColumn("as_of", F.lit("2026-08-31").cast("date")))
    bookstore.merge(spark, new, path)
    got = {(r.portfolio_id, str(r.as_of)): [x.instrument for x in r.holdings] for r in bookstore.read(spark, path).collect()}
    assert got == {("1", "2026-08-31"): ["A", "B"], ("2", "2026-08-31"): ["C"], ("2", "2026-07-31"): ["C"]}
    cat = spark.createDataFrame([("1", "1")], "code string, portfolio_id string").withColumn("advertised", F.array(F.lit("2026-08-31").cast("date"), F.lit("2026-08-15").cast("date")))
    bookstore.publish_indexes(spark, path, cat)
    assert spark.read.json(f"{path}/filings").count() == 2 and spark.read.json(f"{path}/latest").count() == 2
    assert spark.read.json(f"{path}/catalog").first().available_as_of == ["2026-08-31"]


def test_subset_sums(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],)], "w array<double>")
    for target, want in ((3.0, True), (7.0, True), (4.0, False), (100.0, False)):
        assert df.select(compare.can_roll_up(F.lit(target), F.col("w")).alias("x")).first().x is want


def test_futures_policy(spark):
    from ledgerlake.functions.classify import is_cash, is_future

    def f(name, section="", isin=None, swaps=False, options=False):
        return spark.range(1).select(is_future(F.lit(name), F.lit(section), F.lit(None).cast("string"), F.lit(isin).cast("string"), F.lit(False), F.lit(swaps), F.lit(options)).alias("x")).first().x

    assert f("NIFTY 28-Jul-2026") and f("Acme Ltd JUL-2026") and f("x", "Stock Futures")
    assert not f("Covered call 28-Jul-2026") and not f("Treasury Bill 28-Jul-2026") and not f("Interest Rate Swap") and f("Interest Rate Swap", swaps=True)
    assert f("NIFTY Put", options=True) and not f("Acme Ltd", "Stock Futures", "INE1")
    c = lambda n, s="", i=None: spark.range(1).select(is_cash(F.lit(n), F.lit(s), F.lit(i).cast("string")).alias("x")).first().x
    assert c("TREPS") and c("whatever", "Cash / Bank") and not c("7% paper", "Reverse repo") and not c("OIS", "TREPS")


def test_pairs_that_hold_one_another(spark):
    import random

    from ledgerlake.operators import matching

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    keys = [word(rng.choice([1, 3, 5, 9, 14])) for _ in range(40)]
    names = [word(rng.choice([2, 9, 11, 20])) for _ in range(40)] + [keys[0] + "zz", "x" + keys[5]]
    a = spark.createDataFrame([(i, i % 2, k) for i, k in enumerate(keys)], "label_id long, block int, __a string")
    b = spark.createDataFrame([(i, i % 2, k) for i, k in enumerate(names)], "code long, block int, __b string")
    got = {(r.label_id, r.code) for r in matching.holding_pairs(a, b, "block").collect()}
    want = {(i, j) for i, x in enumerate(keys) for j, y in enumerate(names) if i % 2 == j % 2 and (x in y or (len(y) >= 10 and y in x))}
    assert got == want and len(want) > 50
