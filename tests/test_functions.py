import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import classify, dates, numbers, text
from ledgerlake.functions.similarity import indel, partial, token_set, token_sort


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "day, filing, target, kind",
    [("2026-08-14", "2026-08-15", "2026-08-15", "fortnightly"), ("2026-08-15", "2026-08-15", "2026-08-15", "fortnightly"), ("2026-08-20", None, "2026-08-31", "monthly"), ("2026-02-25", "2026-02-28", "2026-02-28", "monthly"), ("2026-08-31", "2026-08-31", "2026-08-31", "monthly"), ("2026-08-03", None, "2026-08-15", "fortnightly")],
)
def test_slices(spark, day, filing, target, kind):
    d = F.lit(day).cast("date")
    got = spark.range(1).select(dates.filing_slice(d).cast("string").alias("f"), dates.target_slice(d).cast("string").alias("t"), dates.cadence(d).alias("c")).first()
    assert (got.f, got.t, got.c) == (filing, target, kind)


@pytest.mark.parametrize(
    "banner, as_of",
    [
        ("PORTFOLIO STATEMENT AS ON : 46218", "2026-07-15"),
        ("as on 2026-08-31", "2026-08-31"),
        ("report-15-Aug-26.xls", "2026-08-15"),
        ("As on August 31, 2026", "2026-08-31"),
        ("31/08/2026", "2026-08-31"),
        ("08/31/2026", "2026-08-31"),
        ("Maturing APR 2028  Jul 2026.xlsx", "2026-07-31"),
        ("30th June 2026", "2026-06-30"),
        ("book_15_08_2026_", None),
        ("no date at all", None),
        ("30/02/2026", None),
        (None, None),
    ],
)
def test_parse_as_of(spark, banner, as_of):
    got = one(spark, dates.parse_as_of(F.lit(banner).cast("string")).cast("string"))
    assert got == as_of


def test_calendar_neighbours(spark):
    def near(day, kind):
        d = F.lit(day).cast("date")
        r = spark.range(1).select(dates.previous_filing(d, F.lit(kind)).cast("string").alias("p"), dates.next_filing(d, F.lit(kind)).cast("string").alias("n")).first()
        return r.p, r.n

    assert near("2026-03-15", "fortnightly") == ("2026-02-28", "2026-03-31")
    assert near("2026-03-31", "fortnightly") == ("2026-03-15", "2026-04-15")
    assert near("2026-03-31", "monthly") == ("2026-02-28", "2026-04-30")


def test_period_keys_february(spark):
    got = one(spark, dates.period_keys(F.lit("2028-02-01").cast("date"), F.lit("fortnightly")))
    assert got == [dt.date(2028, 2, 15), dt.date(2028, 2, 29)]


@pytest.mark.parametrize("raw, want", [("2026-08", "2026-08-31"), ("2026-08-15", "2026-08-15"), ("5/8/2026", "2026-08-05"), ("5 Aug 2026", "2026-08-05"), ("garbage", None), ("2026-13", None), ("", None)])
def test_normalize_as_of(spark, raw, want):
    assert one(spark, dates.normalize_as_of(F.lit(raw)).cast("string")) == want


@pytest.mark.parametrize("raw, api, parser", [("1,234.50", 1234.5, 1234.5), ("7.5%", 7.5, 7.5), ("Rs. 20", 20.0, None), ("nil", None, None), ("1d", 1.0, None), ("nan", None, None), ("abc", None, None), ("(12)", 12.0, None), ("-3e2", -300.0, -300.0), (None, None, None)])
def test_numbers(spark, raw, api, parser):
    c = F.lit(raw).cast("string")
    got = spark.range(1).select(numbers.parse_number(c).alias("a"), numbers.parser_number(c).alias("p")).first()
    assert (got.a, got.p) == (api, parser)


@pytest.mark.parametrize(
    "name, section, isin, kind",
    [
        ("Interest Rate Swap", "Cash and other", None, "derivative"),
        ("TREPS", "", None, "cash"),
        ("Treasury Bill repo", "", None, "money_market"),
        ("Some Fund", "", "INF123456789", "fund_unit"),
        ("Gold", "", None, "commodity"),
        ("Sovereign Gold Bond", "", None, "debt"),
        ("7.26% GOI 2032", "", "IN0020220037", "debt"),
        ("Acme Ltd", "Equity & equity related", "INE000A01010", "equity"),
        ("thing", None, None, "other"),
        (None, None, None, "other"),
    ],
)
def test_holding_type(spark, name, section, isin, kind):
    cols = [F.lit(x).cast("string") for x in (name, section, None, isin)]
    assert one(spark, classify.holding_type(*cols)) == kind


def test_rating_split(spark):
    def split(*v):
        r = one(spark, classify.industry_and_rating(*[F.lit(x).cast("string") for x in v]))
        return r.industry, r.rating

    assert split("Banks", "CRISIL AAA", None) == ("Banks", "CRISIL AAA")
    assert split(None, "Sovereign", None) == (None, "Sovereign")
    assert split(None, "Banks", None) == ("Banks", None)
    assert split("Banks", "Banks", "AA+") == ("Banks", "AA+")


def test_text_keys_are_idempotent(spark):
    for f in (text.norm_text, text.compact, text.base_name, text.squeeze):
        for s in ("A & B  Fund - Direct Plan - Growth", "", "  x  ", "Ünïcode Name (IDCW)"):
            once = one(spark, f(F.lit(s)))
            assert one(spark, f(F.lit(once))) == once


def test_likeness():
    assert indel("abc", "abc") == 100 and indel("", "") == 100 and indel("a", "b") == 0
    assert token_sort("a b c", "c b a") == 100 and token_set("a b", "a b c") == 100
    assert partial("bc", "abcd") == 100
    assert abs(indel("kitten", "sitting") - 200 * 4 / 13) < 1e-9
