"""Rules over columns, each applied to every part: a part's key picks one of a table of cases, whose results are stated.

The SQL states the expected result of each case, so that a rule is compared with what it is meant to give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import classify, dates, landed, names, numbers
from ..functions import similarity as S
from ..functions import text as T
from ..operators import compare, matching, sheets
from ..sources import pages
from .registry import query

Case = tuple[tuple, object]


def _lit(v) -> Column:
    return F.lit(v).cast("string") if v is None or isinstance(v, str) else F.lit(v)


def _sql(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else f"{v}::DOUBLE"


def cases(name: str, table: list[Case], rule: Callable[..., Column], doc: str) -> None:
    """Register ``rule`` over the inputs of ``table``: ((inputs), result) rows; a result is a text, a number, a truth value or null."""
    n = len(table)
    kind = next((type(r) for _, r in table if r is not None), str)
    sql_type = {bool: "BOOLEAN", str: "VARCHAR", float: "DOUBLE", int: "DOUBLE"}[kind]
    whens = " ".join(f"WHEN {i} THEN {_sql(r if kind is not float or r is None else float(r))}" for i, (_, r) in enumerate(table))

    def run(t):
        rows = F.array(*[F.struct(*[_lit(x).alias(f"x{k}") for k, x in enumerate(inputs)]) for inputs, _ in table])
        picked = t.part.select("p_partkey", F.element_at(rows, (F.col("p_partkey") % n + 1).cast("int")).alias("c")).select("p_partkey", "c.*")
        out = rule(*[F.col(f"x{k}") for k in range(len(table[0][0]))])
        return picked.select("p_partkey", out.cast({bool: "boolean", str: "string"}.get(kind, "double")).alias("result"))

    run.__doc__ = doc
    query(name, f"SELECT p_partkey, CAST(CASE p_partkey % {n} {whens} END AS {sql_type}) AS result FROM part")(run)


cases("holding_types", [
    (("Interest Rate Swap", "Cash and other", None, None), "derivative"), (("Nifty Index Futures", None, None, None), "derivative"), (("Reliance Ltd", None, "Index Options", None), "derivative"),
    (("TREPS", "", None, None), "cash"), (("Net Receivables", "", None, ""), "cash"), (("Some receivable", "Cash and Other Net Current Assets", None, None), "cash"), (("Clearing Corporation of India", None, None, None), "cash"),
    (("Treasury Bill repo", "", None, None), "money_market"), (("Some Fund", "", None, "INF123456789"), "fund_unit"), (("Nippon ETF Liquid", None, None, None), "fund_unit"), (("Gold", "", None, None), "commodity"), (("Gold 995 purity", None, None, None), "commodity"),
    (("Sovereign Gold Bond 2028", "", None, None), "debt"), (("7.26% GOI 2032", "", None, "IN0020220037"), "debt"), (("Acme", "Non Convertible Debentures", None, None), "debt"), (("State Bank CP", "Commercial Paper", None, "INE062A14XY1"), "money_market"),
    (("Acme Ltd", "Equity & equity related", None, "INE000A01010"), "equity"), (("Apple Inc", None, None, "US0378331005"), "equity"), (("Foo plc", None, None, None), "equity"), (("thing", None, None, None), "other"), ((None, None, None, None), "other"), (("Brookfield REIT", "REIT units", "Realty reits", None), "equity"),
], classify.holding_type, "The published contract's holding types.")

cases("futures_predicate", [
    (("HDFC Bank Covered Call$$", None, None, None, False, True, True), False), (("Interest Rate Swap 5Y", "Derivatives", None, None, False, False, True), False), (("IRS pay fixed", None, None, None, False, True, True), True),
    (("NIFTY 25000 CALL", None, None, None, False, True, False), False), (("Acme Ltd", "Index Options", None, None, False, True, True), True), (("Acme Ltd", "Futures", None, None, False, True, True), True), (("Acme Ltd", "Stock Futures", None, "INE000A01010", False, True, True), False),
    (("Acme Ltd", "Stock Futures", None, "INE000A01010", True, True, True), True), (("Some Mutual Fund", "f) Derivative", None, "INF000A01010", False, True, True), False), (("Acme Ltd", None, "Stock Futures", None, False, True, True), True),
    (("BANKNIFTY 28-Jul-2026", None, None, None, False, True, True), True), (("HDFC Bank Ltd.28/07/2026", None, None, None, False, True, True), True), (("MAT - 24/07/2037", None, None, None, False, True, True), False), (("HDFC Bank Ltd JUL-2026", None, None, None, False, True, True), True),
    (("NIFTY Jul26", None, None, None, False, True, True), True), (("ITC Ltd.-OCT2026", None, None, None, False, True, True), True), (("BLUE STAR LTD. - August 2026 - Future", None, None, None, False, True, True), True), (("GOLD-05AUG2026-MCX", None, None, None, False, True, True), True),
    (("GOI 18-Aug-2055", None, None, None, False, True, True), False), (("TREPS 03-Aug-2026", None, None, None, False, True, True), False), (("7.1% Bond 18-Aug-2035", None, None, None, False, True, True), False), (("Infosys Limited 25/08/2026", None, None, None, False, True, True), True),
    (("REC LTD - 7.58% - 31/05/2029", None, None, "INE020B08EL2", False, True, True), False), (("ICICI Bank Ltd $$", None, None, None, False, True, True), True), (("**Acme NCD $$", None, None, None, False, True, True), False), (("182 Day T-Bill # $$", None, None, None, False, True, True), False),
    (("SILVER COMMODITY^", None, None, None, False, True, True), True), (("Structured note^^", None, None, None, False, True, True), False), (("Net Current Assets^", None, None, None, False, True, True), False), (("Plain Equity Ltd", "Equity", "Banks", "INE000A01010", True, True, True), False),
], classify.is_future, "Futures, options and swaps under a house's policy.")

cases("cash_predicate", [
    (("TREPS", None, None), True), (("Reverse Repo 2026", None, None), True), (("Interest Rate Swap - CCIL", None, None), False), (("Acme Ltd", "Cash and Other Net Current Assets", None), True), (("Acme Ltd", "Cash and Other Net Current Assets", "INE000A01010"), False),
    (("7.5% Acme NCD", "TREPS / Reverse repo", None), False), (("Commercial Paper", "TREPS", None), False), (("Acme Ltd", "Equity", None), False), ((None, None, None), False), (("Margin Money", "", ""), True), (("OIS 2y", "cash margin", None), False),
], classify.is_cash, "The parser's cash test.")

cases("rating_shape", [(("AAA",), True), (("CRISIL AAA",), True), (("ICRA A1+",), True), (("[ICRA]AAA",), False), (("Sovereign",), True), (("Banks",), False), (("",), False), ((None,), False), (("AA+ / Stable",), True), (("a2",), True), (("AAAA",), False), (("Not Applicable",), True)], classify.looks_rating, "Whether a cell is a rating.")

cases("industry_or_rating", [
    (("Banks", "CRISIL AAA", None), "Banks|CRISIL AAA"), ((None, "Sovereign", None), "-|Sovereign"), ((None, "Banks", None), "Banks|-"), (("Banks", "Banks", "AA+"), "Banks|AA+"), ((None, None, None), "-|-"), (("Finance", None, "A1+"), "Finance|A1+"),
], lambda i, m, r: F.concat_ws("|", *[F.coalesce(classify.industry_and_rating(i, m, r)[k], F.lit("-")) for k in ("industry", "rating")]), "A combined column's industry and rating.")

cases("file_reasons", [
    (("https://h/x.pdf", "Portfolio Aug 2026", "2026-08-01", "2026-08-31", False), "not_spreadsheet"), (("https://h/Half-Yearly Portfolio Aug 2026.xlsx", None, "2026-08-01", "2026-08-31", False), "excluded_non_portfolio"),
    (("https://h/Consolidated SEBI Portfolio Aug 2026.xlsx", None, "2026-08-01", "2026-08-31", False), "month_in_name"), (("https://h/Weekly Aug 2026.xlsx", None, "2026-08-01", "2026-08-31", False), "weekly_not_portfolio"),
    (("https://h/weekly-and-monthly Aug 2026.xlsx", None, "2026-08-01", "2026-08-31", False), "month_in_name"), (("https://h/slug.xlsx", "Jul 2026", "2026-08-01", "2026-08-31", True), "adapter_period"), (("https://h/Portfolio Jul 2026.xls", None, "2026-08-01", "2026-08-31", False), "wrong_month"),
    (("https://h/Portfolio 31-Aug-2026.xlsx", None, "2026-08-01", "2026-08-31", False), "as_of_slice"), (("https://h/Portfolio 15-Aug-2026.xlsx", None, "2026-08-01", "2026-08-31", False), "wrong_as_of_slice"), (("https://h/Portfolio.xlsx", None, "2026-08-01", "2026-08-31", False), "undated_no_month"),
    (("https://h/Portfolio Aug 2026.zip", None, "2026-08-01", None, False), "month_in_name"), (("https://h/Portfolio.xlsm?x=1", None, "2026-08-01", None, False), "spreadsheet_on_disclosure_page"), (("https://h/prc matrix.xlsx", None, None, None, False), "excluded_non_portfolio"), (("https://h/a", "book.csv", None, None, False), "spreadsheet_on_disclosure_page"),
], lambda u, n, p, k, tr: classify.file_reason(u, n, dates.extract_dates(_both(u, n)), dates.all_months(_both(u, n)), dates.matches_as_of(_both(u, n), k.cast("date")), p.cast("date"), k.cast("date"), tr), "Why a disclosure file is kept or not.")


def _both(u: Column, n: Column) -> Column:
    return F.concat_ws(" ", u, n)


cases("as_of_banners", [
    (("PORTFOLIO STATEMENT AS ON : 46218",), "2026-07-15"), (("as on 2026-08-31",), "2026-08-31"), (("report-15-Aug-26.xls",), "2026-08-15"), (("As on August 31, 2026",), "2026-08-31"), (("31/08/2026",), "2026-08-31"), (("08/31/2026",), "2026-08-31"),
    (("Maturing APR 2028  Jul 2026.xlsx",), "2026-07-31"), (("30th June 2026",), "2026-06-30"), (("no date at all",), None), (("30/02/2026",), None), ((None,), None), (("Feb 2028",), "2028-02-29"), (("46218",), None),
], dates.parse_as_of, "As-of dates of banners.")

cases("as_of_choice", [
    (("2026-07-31", "2026-08-15", "Book 15th-Aug-2026.xlsx"), "2026-08-15"), (("2026-08-31", "2028-04-30", "Maturity APR 2028.xlsx"), "2026-08-31"), ((None, "2026-08-15", "x"), "2026-08-15"), (("2026-08-31", None, "x"), "2026-08-31"), ((None, None, None), None), (("2026-07-31", "2026-08-15", "15-08-2026"), "2026-08-15"), (("2026-07-31", "2026-08-31", "Aug_2026"), "2026-07-31"),
], lambda r, f, n: dates.choose_as_of(r.cast("date"), f.cast("date"), n), "The sheet's date or the file name's.")

cases("as_of_normal_forms", [(("2026-08",), "2026-08-31"), (("2026-08-15",), "2026-08-15"), (("5/8/2026",), "2026-08-05"), (("5 Aug 2026",), "2026-08-05"), (("garbage",), None), (("2026-13",), None), (("",), None), (("2028-02",), "2028-02-29"), ((None,), None), (("2026-02-30",), None)], dates.normalize_as_of, "An as-of parameter in its accepted forms.")

cases("as_of_strict", [(("2026-08",), "2026-08-31"), (("2026-08-15",), "2026-08-15"), (("2026-02-30",), "2026-02-30"), (("5/8/2026",), ""), ((None,), ""), ((" 2026-02 ",), "2026-02-28"), (("",), "")], dates.strict_as_of, "The strict form: an ISO day unchecked, or a year-month's end.")

cases("days_in_labels", [
    (("Portfolio as on 31-08-2026.xlsx",), "2026-08-31"), (("fortnight 15 Aug 2026 and 31 Aug 2026",), "2026-08-15,2026-08-31"), (("2026-08-31_2026-08-15.zip",), "2026-08-15,2026-08-31"), (("x 31082026.xls",), "2026-08-31"), (("August 15, 2026",), "2026-08-15"), (("none",), ""), ((None,), ""), (("30/02/2026",), ""), (("15.08.2026",), "2026-08-15"),
], lambda c: F.array_join(F.transform(dates.extract_dates(c), lambda d: d.cast("string")), ","), "All valid days named in a label.")

cases("last_month_of_label", [(("APR 2028 book Aug 2026",), "2026-08-01"), (("sept 2026",), "2026-09-01"), (("none",), None), ((None,), None), (("May-2026",), "2026-05-01"), (("December 2025, January 2026",), "2026-01-01")], dates.last_month, "The last month and year of a label.")

cases("month_match_states", [(("Aug 2026", "2026-08-01"), True), (("Jul 2026", "2026-08-01"), False), (("none", "2026-08-01"), None), (("Jul 2026 Aug 2026", "2026-08-01"), True)], lambda t, m: dates.month_match(dates.all_months(t), m.cast("date")), "Whether a label names the month: yes, no, or unknown.")

cases("filing_neighbours", [
    (("2026-03-15", "fortnightly"), "2026-02-28,2026-03-31"), (("2026-03-31", "fortnightly"), "2026-03-15,2026-04-15"), (("2026-03-31", "monthly"), "2026-02-28,2026-04-30"), (("2026-12-31", "monthly"), "2026-11-30,2027-01-31"), (("2026-01-15", "fortnightly"), "2025-12-31,2026-01-31"), (("2028-02-29", "fortnightly"), "2028-02-15,2028-03-15"),
], lambda d, k: F.concat_ws(",", dates.previous_filing(d.cast("date"), k).cast("string"), dates.next_filing(d.cast("date"), k).cast("string")), "The filings before and after a filing.")

cases("day_numbers", [((46218,), "2026-07-15"), ((30000,), "1982-02-18"), ((29999,), None), ((80001,), None), ((44562,), "2022-01-01")], dates.serial_date, "A spreadsheet's day numbers.")
cases("nav_dates", [(("31-Aug-2026",), "2026-08-31"), (("2026-08-31T00:00:00Z",), "2026-08-31"), (("5-Feb-2026",), "2026-02-05"), (("N.A.",), None), ((None,), None)], dates.nav_date, "Dates of the price lists.")
cases("folder_dates", [(("2026-08-30", "2026-08-31"), "2026-08-31"), (("2026-08-30", None), "2026-08-30"), ((None, None), None)], lambda a, b: dates.clamp_to_folder(a.cast("date"), b.cast("date")), "The folder's date rules.")
cases("stale_labels", [(("31-May-2026", "2026-06"), True), (("30 June 2026", "2026-06"), False), (("JUL 26", "2026-06"), True), (("30-Jun-2026", "2026-07-15"), True), (("15-Jul-2026", "2026-07-15"), False), (("31-Jul-2026", "2026-07-15"), True), ((None, "2026-06"), False), (("May", "2026-08"), False)], dates.stale_label, "Whether a label's month is another period's.")
cases("two_digit_years", [(("Jul_31",), False), (("Jul_26",), True), (("Aug-15",), False), (("Sep 25",), True), (("Jul_2026",), False), ((None,), False)], dates.year_guard, "Whether two digits after a month are a year.")
cases("source_cadence", [
    (("Fortnightly portfolio 15 Sep 2026.xlsx", "2026-09-30", "monthly"), False), (("Monthly portfolio Sep 2026.xlsx", "2026-09-30", "monthly"), True), (("debt_31-Jul-2026.xlsx", "2026-07-15", "fortnightly"), False), (("debt 15-Jul-2026.xlsx", "2026-07-15", "fortnightly"), True),
    (("in_mf_monthly_07.xls", "2026-07-15", "fortnightly"), False), (("FortnightlyPortfolioJuly312026.xlsx", "2026-07-15", "fortnightly"), False), ((None, "2026-07-15", "fortnightly"), True), (("anything", None, "monthly"), True), (("fortnight as on 15", "2026-09-15", "fortnightly"), True),
], lambda s, d, k: dates.source_fits_cadence(s, d.cast("date"), k), "Whether a source's name goes with its slice.")

cases("name_root_keys", [(("Owsal Glit Fund",), "oswalgiltfund"), (("Large & Midcap Fund",), "largeandmidcapfund"), (("Bharat Bond ETF Fund of Funds",), "bharatbondfof"), (("MMF Plan",), "moneymarketfundplan"), (("Short Duratio Fund",), "shortdurationfund"), (("Low Duratio",), "lowduration"), (("Interval Fund Interval Fund II",), "intervalfundii"), ((None,), "")], names.root_key, "Keys in which renamed and misspelt names meet.")
cases("label_expansions", [(("Edel NY 50 IDX",), "Edelweiss Nifty 50 Index Fund"), (("LMcap 250",), "LargeMidcap250"), (("G-S Fund",), "G-Sec Fund"), (("WD HC (I)",), "World Healthcare India"), (("FTP Series - 2",), "FTP Series II"), (("Fund of Funds - Conservative",), "FOF - C"), (("Multi-Asset Allocation Fund",), "Multi Asset Fund"), (("Smallcap250 Momentum Quality 100",), "Smallcap 250 Momentum quality index"), (("Fixed Term Plan 5",), "Fixed Term 5"), (("Unit Linked Insurance Scheme",), "ULIS"), (("",), "")], names.expand, "Short labels in full.")
cases("variant_tails", [(("Acme Liquid Fund - Unclaimed Redemption",), "Acme Liquid Fund"), (("Acme Bond Fund Retail Plan",), "Acme Bond Fund"), (("Acme Fund (Formerly Beta Fund)",), "Acme Fund"), (("Acme Equity Fund",), "Acme Equity Fund"), (("Acme Super Institutional Cumulative",), "Acme")], names.strip_variant, "Names without variant tails.")
cases("descriptions", [(("Acme Fund (An open ended equity scheme)",), "Acme Fund"), (("Acme Fund - An Open Ended Debt Scheme",), "Acme Fund"), (("Acme (A (B (C)))",), "Acme (A (B (C)))"), (("Acme",), "Acme"), (("Monthly Portfolio Statement of Acme Fund as on 31-Jul-2026",), "Acme Fund"), (("IB01 - Acme Fund (1879 DAYS)",), "Acme Fund"), (("Scheme Name :",), "")], names.strip_description, "Names without descriptions.")
cases("peeled_labels", [(("ABCD Fund as on 31 Aug 2026",), "ABCD Fund as on 31 Aug 2026|ABCD Fund|Fund"), (("ONE",), "ONE"), (("Flexi Cap Aug 2026",), "Flexi Cap Aug 2026|Flexi Cap|Cap"), (("",), "")], lambda c: F.array_join(names.peel(c), "|"), "A label's candidates in order.")
cases("pack_codes", [(("IFCF_portfolio",), "IFCF"), (("Portfolio (RLF) Aug",), "RLF"), (("portfolio-SBI1",), "SBI1"), (("plain name",), None)], names.pack_code, "Short codes of file names.")
cases("fund_names_of_files", [(("AcmeFlexiCapFund_Monthly_Portfolio_Aug_2026",), "Acme Flexi Cap Fund"), (("Acme-Liquid%20Fund-31",), "Acme Liquid Fund"), (("Portfolio",), "")], names.fund_from_file, "Fund names of file names.")
cases("shortcode_shape", [(("IFCF",), True), (("A",), False), (("1234",), False), (("TOTAL",), False), (("AB1",), True), (("ab",), False), (("ABCDEFGHIJK",), False)], names.is_shortcode, "Whether a text is a short code.")
cases("fund_name_shape", [(("Acme Equity Fund",), True), (("Fund",), False), (("Nifty Next 50 ETF",), True), (("Disclaimer",), False), (("Sheet1",), False), ((None,), False), (("Some long heading",), False)], names.looks_like_fund, "Whether a text is a fund's name.")
cases("closed_end_names", [(("Acme FMP Series 12",), True), (("Acme Fixed Maturity Plan",), True), (("Acme Interval Fund",), True), (("Acme Liquid Fund",), False), ((None,), False), (("Capital Protection Oriented",), True)], names.is_closed_end, "Closed-end funds.")
cases("debt_like_names", [(("Acme Liquid Fund",), True), (("Acme Gilt",), True), (("Acme Flexi Cap",), False), (("Banking & PSU Debt",), True), (("Nifty 50 Index",), False), (("Equity Savings Fund",), True), (("Arbitrage Fund",), True), (("Floater",), True), ((None,), False)], names.is_debt_like, "Debt and money-market funds.")
cases("secondary_names", [(("Acme Fund Unclaimed Dividend",), True), (("Acme Institutional",), True), (("Acme Fund",), False), (("Erstwhile Beta",), True), ((None,), False)], names.is_secondary, "Variants of a fund.")
cases("base_fund_names", [(("Acme Fund - Direct Plan - Growth",), "Acme Fund"), (("Acme Fund (IDCW)",), "Acme Fund"), (("Acme Growth Fund",), "Acme Growth Fund"), (("Acme Fund Regular Plan Dividend Payout",), "Acme Fund"), (("",), "")], T.base_name, "A fund's name without plan words.")
cases("empty_tokens", [(("nil",), None), (("N/A",), None), ((" - ",), None), (("0",), "0"), ((" x ",), "x"), (("% to NAV",), None), (("",), None), ((None,), None)], T.text_or_null, "Tokens that stand for no value.")
cases("clean_labels", [(("a b",), "a b"), (("﻿x​ y",), "x y"), (("  a   b ",), "a b"), (("",), "")], T.clean_label, "Zero-width and no-break characters.")
cases("plain_text", [(("<b>A</b> &amp; <i>B</i>",), "A & B"), (("a&nbsp;b &lt;c&gt;",), "a b <c>"), (("x<br/>y",), "x y"), (("&quot;q&quot; &#39;s",), "\"q\" 's"), (("",), "")], T.strip_tags, "Markup removed, references decoded.")
cases("header_cells", [(("Name of\nthe Instrument :",), "Name of the Instrument"), (("Qty_x000D_",), "Qty"), (("- % to NAV -",), "% to NAV"), (("",), "")], T.collapse_header, "Header cells on one line.")
cases("invested_in_hosts", [(("Acme Unclaimed (Invested in Acme Overnight Fund)",), "Acme Overnight Fund"), (("Acme invested in Beta Liquid",), "Beta Liquid"), (("Acme",), None)], T.invested_in, "The host fund that a name tells.")
cases("short_codes", [(("ab-12 c",), "AB12C"), (("IFCF",), "IFCF"), (("é1",), "1"), (("",), "")], T.shortcode, "Short codes normalised.")
cases("file_names", [(("Acme Fund / Plan",), "Acme_Fund_Plan"), (("a.b-c_d",), "a.b-c_d"), (("  x ",), "x"), (("",), "")], T.safe_name, "Names safe for files.")

cases("rounded_numbers", [((1.23456789,), 1.234568), ((0.0000005,), 0.0), ((0.0000015,), 0.000002), ((-2.5,), -2.5), ((100.0,), 100.0)], numbers.round6, "Six decimal places, half to even.")
cases("weight_tolerance", [((5.0, 5.35), True), ((5.0, 5.36), True), ((5.0, 6.0), False), ((0.1, 0.5), False), ((0.1, 0.4), True), ((100.0, 114.0), True), ((100.0, 116.0), False), ((0.0, 0.0), True)], numbers.within_tolerance, "Weights that count as equal.")
cases("coerced_numbers", [(("1,234.50",), 1234.5), (("7.5%",), 7.5), (("Rs. 20",), 20.0), (("nil",), None), (("1d",), 1.0), (("nan",), None), (("abc",), None), (("(12)",), 12.0), (("-3e2",), -300.0), ((None,), None), (("₹ 1,00,000",), 100000.0)], numbers.parse_number, "The API's number coercion.")
cases("sheet_numbers", [(("1,234.50",), 1234.5), (("7.5%",), 7.5), (("Rs. 20",), None), (("nil",), None), (("1d",), None), (("nan",), None), (("-3e2",), -300.0), ((None,), None), (("",), None)], numbers.parser_number, "The sheet parser's number coercion.")
cases("quality_weights", [(("5.25%",), 5.25), ((" 1,000 ",), 1000.0), (("NIL",), None), (("",), None), ((None,), None), (("x",), None), (("-0.5",), -0.5)], numbers.check_weight, "The quality check's weight coercion.")
cases("plain_decimals", [((1.5,), "1.5"), ((2.0,), "2"), ((0.1234567,), "0.123457"), ((0.0,), "0"), ((-3.25,), "-3.25"), ((100.0,), "100")], numbers.shown6, "Six decimal places without trailing zeros.")
cases("locale_numbers", [((1234567.891, 2), "1,234,567.89"), ((0.5, 2), "0.50"), ((1000.0, 0), "1,000"), ((-12345.678, 1), "-12,345.7")], lambda x, d: F.when(d == 2, F.format_number(x, 2)).when(d == 1, F.format_number(x, 1)).otherwise(F.format_number(x, 0)), "Numbers as they are shown.")
cases("escaped_text", [(("<a & 'b' \"c\">",), "&lt;a &amp; &#39;b&#39; &quot;c&quot;&gt;"), (("plain",), "plain"), ((None,), ""), (("",), "")], T.escaped, "Text as it is shown in markup.")

cases("containment_scores", [(("acmefund", "acmefund"), 100.0), (("acmeliquid", "acmeliquidfund"), 97.8), (("acmeliquidfundplan", "acmeliquidfund"), 98.2), (("abc", "xyz"), 0.0), (("", "acme"), 0.0), (("short", "a" * 40 + "short"), 93.0), (("acmefundgrowth", "acme"), 0.0)], lambda a, b: F.round(matching.containment_score(a, b), 4), "Scores of keys that hold one another.")
cases("name_conflicts", [(("Acme 2027 Fund", "Acme 2028 Fund"), True), (("Acme 2027", "Acme 2027 2028"), False), (("Acme ETF", "Acme Fund"), True), (("Acme FOF", "Acme Fund of Funds"), False), (("Acme", "Acme 2027"), False), (("Acme Gold ETF FOF", "Acme Gold ETF"), True)], matching.structure_conflict, "Names that can't be one fund's.")
cases("token_sort_scores", [(("a b c", "c b a"), 100.0), (("kitten", "sitting"), 61.5385), (("", ""), 100.0), (("abc", "xyz"), 0.0), (("acme fund", "fund acme growth"), 72.0)], lambda a, b: F.round(S.token_sort_ratio(a, b), 4), "Likeness of sorted words.")
cases("token_set_scores", [(("a b", "a b c"), 100.0), (("acme fund", "acme plan"), 66.6667), (("", "a"), 0.0), (("abc", "xyz"), 0.0)], lambda a, b: F.round(S.token_set_ratio(a, b), 4), "Likeness of word sets.")
cases("partial_scores", [(("bc", "abcd"), 100.0), (("acme", "the acme fund"), 100.0), (("", ""), 100.0), (("", "a"), 0.0), (("abcd", "abxd"), 75.0)], lambda a, b: F.round(S.partial_ratio(a, b), 4), "Likeness to the best stretch.")

cases("header_names", [
    (("Name of the Instrument",), "instrument"), (("ISIN Code",), "isin"), (("Sr. No",), "security_code"), (("Coupon (%)",), "coupon"), (("YTM",), "ytm"), (("Yield to Call",), "ytc"), (("Yield",), "instrument_yield"), (("Residual Maturity",), "residual_maturity"), (("Maturity Date",), "maturity_date"), (("Face Value",), "face_value"),
    (("Put/Call Date",), "put_call_date"), (("Industry / Rating",), "industry_rating"), (("Rating Agency",), "rating_agency"), (("Rating",), "rating"), (("Sector",), "industry"), (("Quantity",), "quantity"), (("Futures Price",), "futures_price"), (("Market/Fair Value (Rs. in Lakhs)",), "market_value"), (("% to NAV",), "pct_nav"),
    (("Macaulay Duration",), "macaulay_duration"), (("Modified Duration",), "modified_duration"), (("Duration",), "duration"), (("Listed Status",), "listed_status"), (("Accrued Interest",), "accrued_interest"), (("Long / (Short)",), "position_side"), (("Margin",), "margin"), (("Market Capitalisation",), "market_cap"), (("Underlying",), "underlying"), (("Asset Class",), "asset_class"), (("Remarks",), None),
], sheets.header_alias, "Canonical names of header cells.")
cases("header_scores", [
    (("Name of the Instrument | ISIN | Quantity | % to NAV",), 25.0), (("Name of Instrument | Market Value",), -1.0 + 7.0), (("seeking income | money market instrument | market",), -1.0 + -9.0), (("ISIN | Rating",), 10.0), (("Total",), -1.0), (("Quantity | Security | Industry",), 5.0), (("MONEY MARKET INSTRUMENTS",), -1.0),
], lambda c: sheets.header_score(F.split(c, r" \| ")), "How much a row looks like a header.")
cases("sheet_codes", [(("IFCF", None, None), "IFCF"), (("Flexi Cap", "IFCF", None), "IFCF"), (("Aggressive Hybrid", "Portfolio", None), "Aggressive Hybrid"), (("Sheet1", None, "RLF"), "RLF"), (("Sheet1", "x y", None), None)], sheets.sheet_shortcode, "A scheme's short code: tab, first cells, label.")

cases("absolute_links", [
    (("https://h.org/a/b", "/c d.xlsx"), "https://h.org/c%20d.xlsx"), (("https://h.org/a/b", "c.xls"), "https://h.org/a/c.xls"), (("https://h.org/a", "https://x.org/y z"), "https://x.org/y%20z"), (("https://h.org/a/", "//x.org/y"), "https://x.org/y"),
], pages.absolute, "Links made absolute, path segments encoded.")
cases("subset_sums", [(("10,20,30", 30.0), True), (("10,20,30", 60.0), True), (("10,20,30", 45.0), False), (("10", 10.0), False), (("1.1,2.2,3.3", 5.55), True), (("", 1.0), False)], lambda v, x: compare.can_roll_up(x, F.transform(F.filter(F.split(v, ","), lambda s: F.length(s) > 0), lambda s: s.cast("double"))), "Whether a roll-up is the sum of two or three of its rows.")


cases("epoch_months", [(("Portfolio Aug 2026", None), "2026-08-01"), (("Portfolio", "1785542400000"), "2026-08-01"), (("Portfolio", "/Date(1785542400000)/"), "2026-08-01"), (("Portfolio", "/Date(1785542400000+0530)/"), "2026-08-01"), (("Jul 2026", "1785542400000"), "2026-07-01"), (("x", "abc"), None), ((None, None), None)], landed.month_of_row, "Months of titles, else of milliseconds.")
cases("compact_days", [(("https://h/a_31082026.xlsx",), "2026-08-31"), (("https://h/a_150826.xls",), "2026-08-15"), (("https://h/a_10082026.xlsx",), None), (("https://h/a_31022026.xlsx",), None), (("https://h/31082026/b.xlsx",), None), ((None,), None), (("28022026.zip?x=1",), "2026-02-28")], landed.compact_day, "Slices' days in file names.")
cases("day_tokens", [(("Portfolio 31-08-2026", "2026-08-31"), True), (("31082026.pdf", "2026-08-31"), True), (("30082026", "2026-08-31"), False), ((None, "2026-08-31"), False)], lambda t, d: landed.names_day(t, d.cast("date")), "Whether a token is the day.")
cases("first_addresses", [((None, "", "/f/a.xlsx"), "https://h.org/f/a.xlsx"), (("https://x.org/b", "c", "d"), "https://x.org/b"), ((" ", "c.xls", "d"), "https://h.org/c.xls"), ((None, None, None), None), (("//f/a", None, None), "https://h.org/f/a")], lambda a, b, c: landed.first_address("https://h.org/", a, b, c), "Addresses out of several fields.")
cases("tab_sections", [(('<div id="one">A</div><div id="two">B</div>',), '>A</div><div '), (('<div id="one">A',), ">A"), (("none",), None)], lambda h: landed.between(h, 'id="one"', 'id="two"'), "What stands between two tabs.")
cases("zipped_labels", [(("a,b,a,c", "x,y,y"), "a=x,b=y"), (("a", "x,y"), "a=x"), (("a,b", "x,y"), "a=x,b=y")], lambda a, b: F.array_join(landed.zipped(F.split(a, ","), F.split(b, ",")), ","), "Labels and addresses by position.")
cases("json_line_rows", [(('0:{"u":"a"}\n1:[1]\nx\n2:{"u":"b"}',), "a,b"), (("nothing",), ""), (('{"u":"c"}',), "c")], lambda p: F.array_join(F.transform(landed.json_lines(p, "u string"), lambda r: r["u"]), ","), "Rows of a payload of lines.")
cases("last_labels", [(("<li><b>Old</b><span>Aug 2026</span><a href='x'>f</a></li>",), "Aug 2026"), (("<li><a href='x'>f</a></li>",), None), (("<p>One</p> <i>Two </i><a>z</a><b>after</b>",), "Two")], landed.last_label, "The last label before a link.")
cases("listing_scopes", [(("Consolidated Portfolio",), "all,consolidated"), (("Acme Fund",), "all,scheme"), (("All Schemes Aug",), "all,consolidated")], lambda t: F.array_join(F.filter(F.array(*[F.when(landed.in_scope(t, s), s) for s in ("all", "consolidated", "scheme")]), lambda x: x.isNotNull()), ","), "Scopes that a title is within.")
