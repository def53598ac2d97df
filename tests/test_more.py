
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import dates, names
from ledgerlake.operators import connectors, increments
from ledgerlake.plans import registry
from ledgerlake.sources import trees


@pytest.mark.parametrize(
    "name, days",
    [
        ("Fund-Portfolio-15-Aug-26.xls", ["2026-08-15"]),
        ("Fund-14-Aug-2026.xlsx", ["2026-08-14"]),
        ("BookJuly152026.xlsx", ["2026-07-15"]),
        ("BookAugust312026.xlsx", ["2026-08-31"]),
        ("x_31Aug2026_99887766", ["2026-08-31"]),
        ("Half_Jul_31_abc123.xls", []),
        ("name_Aug_26_9f.xlsx", ["2026-08-31"]),
        ("fund_15_08_2026_final", ["2026-08-15"]),
        ("https://h.org/monthly/2026/8/20260903.xlsx", ["2026-08-31"]),
        ("portfolio-as-on-August-31,-2026/file", ["2026-08-31"]),
        ("code 31082026", ["2026-08-31"]),
        ("30-Feb-2026", []),
        (None, []),
    ],
)
def test_dates_in_names(spark, name, days):
    got = spark.range(1).select(dates.extract_dates(F.lit(name).cast("string")).alias("d")).first().d
    assert [str(d) for d in got] == days


def test_as_of_match(spark):
    m = lambda s, d: spark.range(1).select(dates.matches_as_of(F.lit(s), F.lit(d).cast("date")).alias("x")).first().x
    assert m("a-14-Aug-2026.xlsx", "2026-08-15") is True and m("a-14-Aug-2026.xlsx", "2026-08-31") is False and m("a.xlsx", "2026-08-31") is None


def test_names(spark):
    def f(g, s):
        return spark.range(1).select(g(F.lit(s)).alias("x")).first().x

    assert f(names.root_key, "Acme Midcap Glit Fund of Funds") == f(names.root_key, "Acme Mid Cap Gilt FOF")
    assert f(names.expand, "Edel NY IDX") == "Edelweiss Nifty Index Fund"
    assert f(names.strip_variant, "Acme Liquid Fund - Unclaimed Redemption - Retail") == "Acme Liquid Fund"
    assert f(names.strip_description, "Acme Fund (An open ended scheme (x)) an open-ended debt scheme") == "Acme Fund"
    assert f(names.peel, "AB1 Acme Fund 31 Aug 2026") == ["AB1 Acme Fund 31 Aug 2026", "AB1 Acme Fund", "Acme Fund"]
    assert f(names.pack_code, "AXL12_portfolio") == "AXL12" and f(names.pack_code, "portfolio") is None
    assert f(names.fund_from_file, "AcmeLiquidFund_31_Aug_2026_Portfolio") == "Acme Liquid Fund"
    assert f(names.is_shortcode, "AB12") and not f(names.is_shortcode, "123") and not f(names.is_shortcode, "NAV")
    assert f(names.looks_like_fund, "Acme Index Fund") and f(names.is_closed_end, "Acme FMP Series 2") and f(names.is_debt_like, "Acme Gilt")
    for g in (names.root_key, names.strip_variant):
        once = f(g, "Acme Largecap Fund Retail - Payout")
        assert f(g, once) == once


def test_trees(spark):
    page = 'x; const data = {"title": "A", "items": [{"name": "Aug 2026 {final}", "path": "/a.xlsx"}, {"name": "B", "kids": [{"label": "Jul 2026", "u": "b.zip?x"}]}]}; more }'
    df = spark.createDataFrame([(1, 7, "https://h.org/p", page), (2, 7, "https://h.org/q", "no json"), (3, 7, "u", None)], "page_id long, amc_id int, url string, html string")
    got = [(r.id, r.path, r.title, r.url) for r in trees.files(df, "page_id", "html", "data").collect()]
    assert got == [(1, "A", "Aug 2026 {final}", "/a.xlsx"), (1, "A/B", "Jul 2026", "b.zip?x")]
    listing = connectors.read(df, "script", "data")
    assert {r.url for r in listing.collect()} == {"https://h.org/a.xlsx", "https://h.org/b.zip?x"}
    assert len(connectors.HOUSES) == 48 and all(x in connectors.listings.POLICIES for h in connectors.HOUSES.values() for x in h[1:])
    chosen = connectors.choose(df, "tata", marker="data").collect()
    assert chosen == []  # neither title says monthly
    assert connectors.choose(df, "wealth_company", marker="data").count() == 2


def test_increments(spark, tmp_path):
    files = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5)], "path string, modified int")
    done = spark.createDataFrame([("a", 2), ("b", 4), ("b", 9)], "path string, modified int")
    assert sorted(r.path for r in increments.todo(files, done).collect()) == ["b", "c"]
    (tmp_path / "x.jsonl").write_text('{"id": 1}\n{"id": 2\n{"id": 3}\n')
    assert sorted(r.id for r in increments.checkpoint_lines(spark, f"file://{tmp_path}/x.jsonl", "id int").collect()) == [1, 3]
    snap = spark.createDataFrame([("f1", 1), ("f2", 1), ("f2", 2)], "file string, x int")
    assert {r.file for r in increments.largest_snapshot(snap).collect()} == {"f2"}
    windows = spark.createDataFrame([("h", "2026-01-20", "2026-02-01")], "house string, first string, last string").selectExpr("house", "date(first) first", "date(last) last")
    j = increments.jobs(windows, ["house"]).orderBy("place").collect()
    assert [(str(r.as_of), r.cadence) for r in j] == [("2026-01-15", "fortnightly"), ("2026-01-31", "fortnightly"), ("2026-01-31", "monthly"), ("2026-02-15", "fortnightly"), ("2026-02-28", "fortnightly"), ("2026-02-28", "monthly")]
    d = increments.deltas(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), spark.createDataFrame([("b", 3), ("c", 1)], "k string, n int"), "k", "n")
    assert {r.k: r.change for r in d.collect()} == {"a": "gone", "b": "changed", "c": "new"}
    t = spark.createDataFrame([("s", 1, "Total : Equity", 50.0), ("s", 2, "Grand Total", 100.0), ("s", 3, "Net Assets", 900.0)], "s string, n int, label string, v double")
    assert increments.total_value(t, ["s"], "label", "v", "n").first().stated_total == 100.0


def test_published_contract_holds_every_holding(spark):
    folder = "/root/testdata/sf0.01"
    want = {r.l_suppkey: r["count"] for r in spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_suppkey").count().collect()}
    assert {r.book: r["count"] for r in registry.QUERIES["published_contract"](spark, folder).groupBy("book").count().collect()} == want


def test_match_cascade_binds_every_part(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.via: r.n for r in registry.QUERIES["match_cascade"](spark, folder).collect()}
    n = spark.read.parquet(f"{folder}/part.parquet").count()
    assert got["shortcode"] == n // 8 and got["shortcode"] + got["direct"] + got.get("fuzzy", 0) == n
