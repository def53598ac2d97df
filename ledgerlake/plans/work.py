"""Queries of the library's table operators: catalog, matching, sheets, exports, serving, incremental runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import books, catalog, compare, connectors, guards, increments, listings, matching, serving, sheets
from ..schemas import HOLDING_FIELDS
from ..sources import bookstore, exports, manifest, paths, schememaster, trees
from .registry import query, real, text


def _date(c: str):
    return F.to_date(c)


# ---------------------------------------------------------------- catalog


@query("catalog_build", """
WITH book AS (SELECT s_suppkey AS b, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey END AS code, s_nationkey AS amc FROM supplier),
plan AS (SELECT c_custkey AS code, c_nationkey AS amc FROM customer),
m AS (SELECT s_suppkey AS m, s_nationkey AS amc, [s_suppkey * 3, s_suppkey * 3 + 1] AS codes, s_suppkey * 3 AS parent FROM supplier WHERE s_suppkey % 3 > 0),
p AS (SELECT m, unnest(list_distinct(codes || [parent])) AS code FROM m),
hit AS (SELECT b.b, p.m, 0 AS r FROM book b JOIN (SELECT code, min(m) AS m FROM p GROUP BY code) p USING (code) UNION ALL SELECT b.b, m.m, 1 FROM book b JOIN m ON m.m = b.b WHERE b.b % 2 = 0 UNION ALL SELECT b.b, m.m, 2 FROM book b JOIN m ON m.m = b.b WHERE b.b % 2 = 1),
got AS (SELECT b, arg_min(m, r * 10000000 + m) AS m FROM hit GROUP BY b),
serves AS (SELECT got.b, p.code FROM got JOIN p USING (m) UNION ALL SELECT b, code FROM book WHERE code IS NOT NULL),
byplan AS (SELECT code, min(b) AS b FROM serves GROUP BY code),
alias AS (SELECT c_custkey AS orphan, c_custkey - 1 AS target FROM customer WHERE c_custkey % 5 = 0),
full_plan AS (SELECT * FROM byplan UNION ALL SELECT a.orphan, min(x.b) FROM alias a JOIN byplan x ON x.code = a.target WHERE a.orphan NOT IN (SELECT code FROM byplan) GROUP BY a.orphan),
fund AS (SELECT c_custkey AS canonical, [c_custkey, c_custkey + 1] AS codes FROM customer WHERE c_custkey % 2 = 0),
mem AS (SELECT canonical, unnest(range(0, 2)) AS pos, unnest(codes) AS code FROM fund),
own AS (SELECT canonical, arg_min(b, pos) AS b FROM mem JOIN full_plan USING (code) GROUP BY canonical),
par AS (SELECT mem.code, arg_min(mem.canonical, mem.pos) AS canonical FROM mem GROUP BY mem.code),
fin AS (SELECT plan.code, plan.amc, par.canonical AS parent_code, coalesce(own.b, full_plan.b) AS book_id FROM plan LEFT JOIN par USING (code) LEFT JOIN own ON own.canonical = par.canonical LEFT JOIN full_plan ON full_plan.code = plan.code)
SELECT code, amc AS amc_id, parent_code, book_id, book_id IS NOT NULL AS has_holdings FROM fin
UNION ALL SELECT NULL, amc, NULL, b, true FROM book WHERE b NOT IN (SELECT b FROM serves)""")
def catalog_build(t):
    """Customers as schemes, suppliers as books, bound by plan code, short code or name."""
    schemes = t.customer.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("amc_id"))
    funds = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("canonical"), F.col("c_name").alias("base_name"), F.array("c_custkey", F.col("c_custkey") + 1).alias("codes"))
    k = F.col("s_suppkey")
    held = t.supplier.select(k.alias("book_id"), F.col("s_nationkey").alias("amc_id"), F.when(k % 4 == 0, k).alias("code"), F.when(k % 2 == 0, F.concat(F.lit("s-"), text(k))).alias("shortcode"), F.when(k % 2 == 1, F.concat(F.lit("Book "), text(k))).alias("name"))
    maps = t.supplier.where("s_suppkey % 3 > 0").select(k.alias("map_id"), F.col("s_nationkey").alias("amc_id"), F.concat(F.lit("S"), text(k)).alias("shortcode"), F.concat(F.lit("BOOK  "), text(k)).alias("name"), (k * 3).alias("parent"), F.array(k * 3, k * 3 + 1).alias("plan_codes"))
    aliases = t.customer.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("orphan"), (F.col("c_custkey") - 1).alias("target"))
    return catalog.build(schemes, funds, held, maps, aliases).select("code", "amc_id", "parent_code", "book_id", "has_holdings")


def _catalog(t) -> DataFrame:
    """Customers as catalog rows; their orders' days are the dates of their books."""
    days = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_set(_date("o_orderdate"))).alias("available_as_of"), F.max(_date("o_orderdate")).alias("latest_as_of"))
    c = t.customer.select(text(F.col("c_custkey") + 10_000).alias("code"), F.col("c_custkey").alias("k"), F.col("c_name").alias("parent_name"), text("c_nationkey").alias("amc_id"), F.col("c_mktsegment").alias("category"), F.concat(F.lit("p"), text("c_custkey")).alias("portfolio_id"), F.lit("/x").alias("local_path"), (F.col("c_custkey") % 3 > 0).alias("has_holdings"))
    return c.join(days, c["k"] == days["o_custkey"], "left").drop("o_custkey", "k")


@query("public_catalog", "SELECT CAST(c_custkey + 10000 AS VARCHAR) AS code, c_name AS parent_name, count(DISTINCT CAST(o_orderdate AS DATE)) AS dates, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2")
def public_catalog(t):
    return catalog.public_row(_catalog(t)).select("code", "parent_name", F.size("available_as_of").cast("long").alias("dates"), text("latest_as_of").alias("latest"))


@query("rewritten_catalog", "SELECT CAST(c_custkey + 10000 AS VARCHAR) AS code, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 2 = 0 THEN 'p' || c_custkey END AS portfolio_id FROM customer")
def rewritten_catalog(t):
    held = t.customer.where("c_custkey % 2 = 0").select(F.concat(F.lit("p"), text("c_custkey")).alias("portfolio_id"))
    out = catalog.rewritten(_catalog(t), held)
    assert "local_path" not in out.columns
    return out.select("code", "portfolio_id")


@query("scheme_cards", "SELECT CAST(c_custkey + 10000 AS VARCHAR) AS code, c_name AS name, CAST(c_nationkey AS VARCHAR) AS amc_id, c_mktsegment AS category FROM customer")
def scheme_cards(t):
    return _catalog(t).select(catalog.scheme_card(F.struct("code", "parent_name", "amc_id", "category"))).select("scheme.*")


@query("resolved_ids", "SELECT c_custkey AS code, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 WHEN c_custkey % 3 = 1 THEN c_custkey * 100 ELSE c_custkey END AS resolved FROM customer")
def resolved_ids(t):
    k = F.col("c_custkey")
    known = t.customer.where("c_custkey % 3 < 2").select(k.alias("code"), F.when(k % 3 == 0, k * 10).alias("portfolio_id"), (k * 100).alias("parent"))
    return catalog.resolve_id(t.customer.select(k.alias("code")), known)


@query("parent_coverage", """
SELECT s_suppkey AS parent, s_name AS name, count(l_orderkey) AS plans, count(*) FILTER (WHERE l_linestatus = 'O') AS with_disclosure, coalesce(substr(array_to_string(list_sort(list(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_shipmode END)), ' | '), 1, 320), '') AS names, count(l_orderkey) = count(*) FILTER (WHERE l_linestatus = 'O') AS coverage_ok
FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2""".replace("l_shipmode", "l_returnflag"))
def parent_coverage(t):
    plans = t.lineitem.select(F.col("l_suppkey").alias("parent"), F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("disclosure"))
    return compare.parent_coverage(t.supplier.select(F.col("s_suppkey").alias("parent"), F.col("s_name").alias("name")), plans)


@query("missing_by_house", "SELECT c_nationkey AS house, count(*) AS total, count(*) FILTER (WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS missing FROM customer GROUP BY 1 HAVING missing > 0")
def missing_by_house(t):
    have = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return compare.missing_by_house(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("house")), have, "house", "k")


@query("missing_lists", """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), h AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y FROM orders)
SELECT y::BIGINT AS y, k, rank FROM (SELECT y.y, c_custkey AS k, row_number() OVER (PARTITION BY y.y ORDER BY c_custkey) AS rank FROM customer CROSS JOIN y LEFT JOIN h ON h.k = c_custkey AND h.y = y.y WHERE h.k IS NULL) WHERE rank <= 50""")
def missing_lists(t):
    have = t.orders.select(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("y"))
    return compare.missing_list(t.customer.select(F.col("c_custkey").alias("k")), have, "k", "y").select("y", "k", F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- matching

_WORDS = ("Alpha", "Bravo", "Charlie", "Delta", "Echo", "Foxtrot", "Golf", "Hotel", "India", "Juliet")


def _word(c):
    """A word that stands for a number under ten millions: a letter for the millions, a syllable for each of six digits. Words of two numbers differ in a letter at least, never by a longer form."""
    s = F.lpad(text(c % 1_000_000), 6, "0")
    return F.concat(F.translate(text(F.floor(c / 1_000_000)), "0123456789", "QRSTUVWXYN"), F.translate(s, "0123456789", "bcdfghjklm"))


@query("house_names", """
SELECT CAST(s_suppkey AS VARCHAR) AS amc_id, CASE WHEN s_suppkey % 4 < 3 THEN 'Q' || translate(lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), '0123456789', 'bcdfghjklm') || ' Asset Management Company Limited' END AS official, CASE WHEN s_suppkey % 4 < 3 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM supplier""")
def house_names(t):
    """Houses bound to official names by their cores, in any of three spellings."""
    k = F.col("s_suppkey")
    word = _word(k)
    unknown = F.concat(F.lit("zz"), F.translate(text(k), "0123456789", "nopqrstvwx"))
    registry = t.supplier.select(text(k).alias("amc_id"), F.when(k % 4 == 0, F.concat(word, F.lit(" Mutual Fund"))).when(k % 4 == 3, unknown).alias("name"), F.when(k % 4 == 1, F.concat(word, F.lit(" AMC Pvt Ltd"))).when(k % 4 == 2, F.concat(F.upper(word), F.lit(" IDF"))).alias("amc_name"))
    official = t.supplier.select(F.concat(word, F.lit(" Asset Management Company Limited")).alias("name"))
    return matching.map_houses(registry, official).select("amc_id", "official", "score")


_VARIANTS = """
WITH p AS (SELECT p_partkey AS k, p_partkey % 5 AS v FROM part)
SELECT k + 1000000 AS code, k AS sibling, {score} AS score FROM p WHERE {where}"""


def _funds(t, tails: list) -> tuple[DataFrame, DataFrame]:
    """Bound funds, and one unbound variant of each, under names that only their own have."""
    k = F.col("p_partkey")
    word = F.concat(_word(k), F.lit(" "), F.reverse(_word(k)))
    base = F.concat(word, F.lit(" Opportunity Fund"))
    tail = F.element_at(F.array(*[f(word, base) for f in tails]), (k % len(tails) + 1).cast("int"))
    # twice the key, and one more for the variant: at a million keys, theirs and those of the variants would meet
    a = t.part.select((k * 2).alias("code"), F.col("p_brand").alias("block"), base.alias("name"))
    return a.unionByName(t.part.select((k * 2 + 1).alias("code"), F.col("p_brand").alias("block"), tail.alias("name"))), a.select("code")


def _told(found: DataFrame) -> DataFrame:
    """Variants by their fund's key and a million, siblings by their key."""
    return found.select(((F.col("code") - 1) / 2 + 1_000_000).cast("long").alias("code"), (F.col("sibling") / 2).cast("long").alias("sibling"), "score")


@query("near_copy_binding", _VARIANTS.format(score="95.0::DOUBLE", where="v < 4"))
def near_copy_binding(t):
    """Equal keys, an optional closing "fund", one name inside the other, a small difference; a name of other words stays unbound."""
    tails = [lambda w, b: F.upper(b), lambda w, b: F.concat(w, F.lit(" Opportunity")), lambda w, b: F.concat(b, F.lit(" Growth")), lambda w, b: F.concat(w, F.lit(" Oportunity Fund")), lambda w, b: F.concat(F.lit("Zz"), F.reverse(w), F.lit(" Large Equity Scheme"))]
    master, bound = _funds(t, tails)
    return _told(matching.near_copies(master, bound, "block"))


@query("variant_siblings", _VARIANTS.format(score="100.0::DOUBLE", where="v < 3"))
def variant_siblings(t):
    """Variants follow the fund whose name they bear or that they invest in; closed-end funds and strangers don't."""
    tails = [lambda w, b: F.concat(b, F.lit(" - Unclaimed Redemption")), lambda w, b: F.concat(F.lit("Zz Pool (Invested in "), b, F.lit(")")), lambda w, b: F.concat(b, F.lit(" Retail")), lambda w, b: F.concat(b, F.lit(" Fixed Maturity Plan")), lambda w, b: F.concat(F.lit("Zz "), F.reverse(w), F.lit(" Scheme"))]
    master, bound = _funds(t, tails)
    return _told(matching.attach_variants(master, bound, "block"))


@query("unmatched_funds", "SELECT p_partkey AS code FROM part WHERE p_partkey % 7 <> 0")
def unmatched_funds(t):
    return matching.unmatched(t.part.select(F.col("p_partkey").alias("code")), t.part.where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("code"))).select("code")


# ---------------------------------------------------------------- sheets


def _grid(t, rows: list) -> DataFrame:
    """A sheet for every customer: rows of cells, some of which hold its own day."""
    d = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    cells = F.array(*[F.array(*[c(d) for c in r]) for r in rows])
    return t.customer.select("c_custkey", F.posexplode(cells).alias("row_no", "cells"))


@query("sheet_as_of", """
SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 THEN DATE '2026-01-01' + CAST(c_custkey % 300 AS INTEGER) ELSE DATE '2026-01-01' + CAST(c_custkey % 300 AS INTEGER) - 40 END AS VARCHAR) AS as_of FROM customer""")
def sheet_as_of(t):
    """A strong banner beats an earlier weak label; price histories don't count; without a banner the first label does."""
    lit = lambda s: lambda d: F.lit(s)
    rows = [[lit("ABC Mutual Fund"), lit("")], [lambda d: F.concat(F.lit("NAV history as on "), F.date_format(F.date_sub(d, 90), "dd-MMM-yyyy")), lit("")], [lit("as on"), lambda d: F.date_format(F.date_sub(d, 40), "dd-MMM-yyyy")], [lambda d: F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Portfolio statement as on "), F.date_format(d, "dd-MMM-yyyy"))).otherwise(""), lit("x")]]
    return sheets.sheet_as_of(_grid(t, rows), ["c_custkey"]).select("c_custkey", text("as_of").alias("as_of"))


@query("sheet_titles", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Alpha Growth Fund' WHEN c_custkey % 3 = 1 THEN 'Beta Nifty 50 Index' END AS title FROM customer")
def sheet_titles(t):
    k = F.col("c_custkey") % 3
    lit = lambda s: lambda d: F.lit(s)
    rows = [[lit("Regd: Registration No 12 of the Fund"), lit("short")], [lambda d: F.when(k == 0, "Monthly Portfolio Statement of Alpha Growth Fund as on 31 Aug 2026").otherwise(""), lambda d: F.when(k == 1, "Beta Nifty 50 Index").otherwise("Name of the Instrument")], [lit("ISIN"), lit("Quantity")]]
    return sheets.title_of(_grid(t, rows), ["c_custkey"])


@query("block_totals", """
SELECT o_custkey AS book, arg_max(o_totalprice, CASE o_orderstatus WHEN 'F' THEN 20 WHEN 'O' THEN 18 ELSE 12 END * 1000000000.0 + o_totalprice) AS stated_total FROM orders GROUP BY 1""")
def block_totals(t):
    """The stated total among candidate rows of a book, by label, then by size."""
    label = F.when(F.col("o_orderstatus") == "F", "GRAND TOTAL").when(F.col("o_orderstatus") == "O", "Total Net Assets").otherwise("Net Assets")
    rows = t.orders.select(F.col("o_custkey").alias("book"), label.alias("label"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("row_no"))
    return increments.total_value(rows, ["book"], "label", "v", "row_no")


@query("parsed_sheets", """
SELECT CAST(c_custkey AS VARCHAR) AS file, ordinal, instrument, section, pct FROM (SELECT c_custkey, unnest([0, 1, 2]) AS ordinal, unnest(['Acme Ltd', 'Beta Ltd', '7.5% Gamma 2031']) AS instrument, unnest(['Equity', 'Equity', 'Debt Instruments']) AS section, unnest(['12.5', '7.5', '80']) AS pct FROM customer)""")
def parsed_sheets(t):
    """A sheet a customer through the table parser: header, sections, totals, the end mark."""
    rows = [["Portfolio of a fund"], ["Name of the Instrument", "ISIN", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"], ["Equity"], ["Acme Ltd", "INE000A01011", "10", "125", "12.5"], ["Beta Ltd", "INE000A01012", "5", "75", "7.5"], ["Sub Total", "", "", "200", "20"], ["Debt Instruments"], ["7.5% Gamma 2031", "INE000A07013", "1", "800", "80"], ["GRAND TOTAL", "", "", "1000", "100"], ["Notes :", "", "", "", ""]]
    cells = F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows])
    grid = t.customer.select(text("c_custkey").alias("file"), F.lit("s").alias("sheet"), F.posexplode(cells).alias("row_no", "cells"))
    return sheets.parse_tables(grid).select("file", "ordinal", "instrument", "section", F.col("pct_nav").alias("pct"))


_LOOK_AHEAD = [
    ["Name of the Instrument", "ISIN", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"], ["Equity"], ["Acme Ltd", "INE000A01011", "10", "500", "50"], ["Certificate of Deposits", "", "", "200", "20"], ["Bank CD", "INE000A16011", "2", "200", "20"],
    ["Reverse Repo", "", "", "100", "10"], ["Reverse Repo (03-Aug-2026)", "", "", "100", "10"], ["TREPS", "", "", "50", "*"], ["Net Current Assets", "", "50", "5", ""], ["Index Futures"], ["Sub Total", "", "", "-20", "-2"],
    ["Name of the Instrument", "Underlying", "Long / (Short)", "Margin", "% to AUM"], ["Futures"], ["NIFTY Aug26", "NIFTY", "Long", "1", "3"], ["Name of Security", "ISIN", "Rating date"], ["Footnote", "INE000A01011", "x"], ["GRAND TOTAL", "", "", "1000", "100"],
]


@query("sheet_look_aheads", """
SELECT s_suppkey::VARCHAR AS file, unnest(range(0, 7)) AS ordinal, unnest(['Acme Ltd', 'Bank CD', 'Reverse Repo (03-Aug-2026)', 'TREPS', 'Net Current Assets', 'Index Futures', 'NIFTY Aug26']) AS instrument, unnest(['Equity', 'Certificate of Deposits', 'Reverse Repo', 'Reverse Repo', 'Reverse Repo', 'Index Futures', 'Futures']) AS section, unnest(['50', '20', '10', '5', '5', '-2', '3']) AS pct, unnest([false, false, false, true, false, false, false]) AS implied FROM supplier""")
def sheet_look_aheads(t):
    """Category totals, dated repos, a weight from the stated total, a table of contracts, and a foreign table that ends the sheet."""
    cells = F.array(*[F.array(*[F.lit(c) for c in r]) for r in _LOOK_AHEAD])
    grid = t.supplier.select(text("s_suppkey").alias("file"), F.lit("s").alias("sheet"), F.posexplode(cells).alias("row_no", "cells"))
    return sheets.parse_tables(grid).select("file", "ordinal", "instrument", "section", F.col("pct_nav").alias("pct"), "implied").withColumn("ordinal", F.col("ordinal").cast("long"))


# ---------------------------------------------------------------- windows of books


@query("margin_rows_drop", "WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, bool_or(l_linestatus = 'O') OVER (PARTITION BY l_orderkey) AS p, l_returnflag FROM lineitem) SELECT book, n FROM w WHERE NOT (l_returnflag = 'R' AND p)")
def margin_rows_drop(t):
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), "l_returnflag", "l_linestatus")
    return books.drop_when_present(w, "book", F.col("l_returnflag") == "R", F.col("l_linestatus") == "O").select("book", "n")


@query("junk_weights", """
WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, CASE WHEN l_orderkey % 2 = 0 THEN 0.0 ELSE l_extendedprice END AS v, l_quantity AS q FROM lineitem)
SELECT book, n, round(CASE WHEN book % 2 = 0 THEN 0.01 * q ELSE v END, 6) AS v, round(CASE WHEN book % 2 = 0 THEN q * 100 / sum(q) OVER (PARTITION BY book) ELSE 1.0 END, 6) AS w FROM w""")
def junk_weights(t):
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), F.when(F.col("l_orderkey") % 2 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("v"), F.col("l_quantity").alias("q"), F.lit(1.0).alias("w"))
    return books.junk_weights(w, "book", "v", "q", "w").select("book", "n", F.round("v", 6).alias("v"), F.round("w", 6).alias("w"))


@query("value_scale", "WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, CASE WHEN l_orderkey % 2 = 0 THEN l_extendedprice * 100000 ELSE l_extendedprice END AS v FROM lineitem) SELECT book, n, round(CASE WHEN max(abs(v)) OVER (PARTITION BY book) >= 1e8 THEN v * 1e-5 ELSE v END, 4) AS v FROM w")
def value_scale(t):
    v = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_extendedprice") * 100_000).otherwise(F.col("l_extendedprice"))
    return books.value_scale(t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), v.alias("v")), "book", "v").select("book", "n", F.round("v", 4).alias("v"))


@query("missing_weights", """
SELECT l_orderkey AS book, l_linenumber AS n, CAST(round(CAST(CASE WHEN l_linenumber % 2 = 0 THEN 5.0 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * 100 / CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_orderkey) AS DOUBLE) END AS DECIMAL(20,8)), 5) AS DOUBLE) AS w FROM lineitem""")
def missing_weights(t):
    """Weights that are null or zero, from the values."""
    given = F.when(F.col("l_linenumber") % 2 == 0, 5.0).when(F.col("l_linenumber") % 3 == 0, 0.0)
    d = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("v"), given.alias("w"))
    return books.ratio_to_total(d, "book", "v", "w", only_missing="w").select("book", "n", real(F.round(F.col("w").cast("decimal(20,8)"), 5)).alias("w"))


@query("allocation_flags", "SELECT l_orderkey AS book, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) BETWEEN 99.9 AND 100.1 OR CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) * 2 BETWEEN 99.9 AND 100.1 AS ok FROM lineitem GROUP BY 1")
def allocation_flags(t):
    """Whether any of a book's totals is 100 within a tenth."""
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("book")).agg(real(F.sum(F.col("l_quantity").cast("decimal(18,2)"))).alias("s"))
    return s.select("book", books.meets_allocation(F.col("s"), F.col("s") * 2).alias("ok"))


# ---------------------------------------------------------------- stores and exports


def _place(t, name: str) -> str:
    """A fresh folder where all executors write."""
    import tempfile

    base = t.spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not t.spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = "file://" + tempfile.mkdtemp(prefix=name)
    return f"{base}/{name}-{uuid.uuid4().hex}"


@query("flat_book_export", "SELECT p_name AS instrument, CAST(p_size AS VARCHAR) AS quantity, 30::BIGINT AS columns FROM part")
def flat_book_export(t):
    """A book written with its thirty columns and read again."""
    path = _place(t, "book")
    exports.write_book(t.part.select(F.col("p_name").alias("instrument"), F.col("p_size").alias("quantity")), path)
    back = t.spark.read.option("header", "true").csv(path)
    return back.select("instrument", "quantity", F.lit(len(back.columns)).cast("long").alias("columns"))


@query("durable_map", """
WITH e AS (SELECT o_custkey % 50 AS amc, o_orderstatus AS code, o_orderkey AS ordinal, o_orderpriority AS alias FROM orders),
s AS (SELECT *, ordinal % 7 = 0 AS sure FROM e)
SELECT CAST(amc AS VARCHAR) AS amc_id, code AS shortcode, arg_min(ordinal, CASE WHEN sure THEN 0 ELSE 1 END * 1000000000 + ordinal)::BIGINT AS code, CASE WHEN bool_or(sure) THEN 'manual' ELSE 'seeded' END AS confidence, array_to_string(list_sort(list(DISTINCT alias)), '|') AS aliases FROM s GROUP BY amc, code""")
def durable_map(t):
    k = F.col("o_orderkey")
    e = t.orders.select(text(F.col("o_custkey") % 50).alias("amc_id"), F.concat(F.lit(" "), "o_orderstatus").alias("shortcode"), F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("aliases"), k.alias("code"), F.when(k % 7 == 0, "manual").alias("confidence"), k.alias("ordinal"))
    return exports.durable_map(e)


@query("match_matrices", """
SELECT CAST(o_custkey % 20 AS VARCHAR) AS amc_id, count(*) AS rows, count(*) FILTER (WHERE o_orderstatus = 'F') AS matched, count(*) FILTER (WHERE o_orderstatus <> 'F') AS open, round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0 / count(*), 2) AS pct FROM orders GROUP BY 1""")
def match_matrices(t):
    """The matrices of every house written, the summary read again."""
    path = _place(t, "matrix")
    m = t.orders.select(text(F.col("o_custkey") % 20).alias("amc_id"), F.when(F.col("o_orderstatus") == "F", "matched").otherwise("open").alias("status"), "o_orderkey")
    exports.write_matrices(m, path)
    return t.spark.read.json(f"{path}/_summary").select("amc_id", "rows", "matched", "open", "pct")


@query("links_export", "SELECT CAST(page_id % 7 AS VARCHAR) AS amc_id, count(*) AS n FROM pages GROUP BY 1")
def links_export(t):
    path = _place(t, "links")
    exports.write_links(t.pages.select((F.col("page_id") % 7).alias("amc_id"), "url"), path)
    return t.spark.read.option("header", "true").csv(path).groupBy(text("amc_id").alias("amc_id")).agg(F.count("*").alias("n"))


@query("mapping_tables", "SELECT CAST(c_nationkey AS VARCHAR) AS amc_id, count(*) AS n, min(c_custkey || '|x') AS least FROM customer GROUP BY 1")
def mapping_tables(t):
    path = _place(t, "mapping")
    m = t.customer.select(text("c_nationkey").alias("amc_id"), F.lit("matched").alias("status"), F.array(text("c_custkey"), F.lit("x")).alias("codes"))
    exports.write_mapping_tables(m, m.limit(0), m.limit(0), path)
    return t.spark.read.option("header", "true").csv(f"{path}/mappings").groupBy("amc_id").agg(F.count("*").alias("n"), F.min("codes").alias("least"))


@query("book_store_merge", "SELECT CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS as_of, o_custkey::VARCHAR AS portfolio_id, count(*) AS n FROM orders GROUP BY ALL")
def book_store_merge(t):
    """Books stored by date, a part of them written again as a merge, and read back."""
    path = _place(t, "store")
    o = t.orders.select(text("o_custkey").alias("portfolio_id"), F.last_day(_date("o_orderdate")).alias("as_of"), F.lit("monthly").alias("cadence"), F.col("o_orderkey").alias("ordinal"), *[F.lit(None).cast("string").alias(f) for f in HOLDING_FIELDS if f not in _NUMBERS], *[F.lit(None).cast("double").alias(f) for f in HOLDING_FIELDS if f in _NUMBERS])
    nested = bookstore.nest(o)
    bookstore.write(nested, path)
    bookstore.merge(t.spark, nested.where(F.col("portfolio_id").cast("long") % 2 == 0), path)
    return bookstore.read(t.spark, path).select(text("as_of").alias("as_of"), "portfolio_id", F.size("holdings").cast("long").alias("n"))


_NUMBERS = ("quantity", "market_value", "pct_nav", "coupon", "ytm", "ytc", "instrument_yield")


@query("path_partitions", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'fortnightly' END AS cadence, CASE c_custkey % 3 WHEN 0 THEN '2026-08' WHEN 1 THEN '2026-08-15' END AS period FROM customer""")
def path_partitions(t):
    k = F.col("c_custkey")
    p = F.when(k % 3 == 0, "/data/Monthly/2026-08/a.xlsx").when(k % 3 == 1, "/data/fortnightly/2026-08-15/b.xlsx").otherwise("/data/other/2026-08/c.xlsx")
    return paths.with_partitions(t.customer.select("c_custkey", p.alias("path"))).select("c_custkey", "cadence", "period")


@query("period_folders", "SELECT '20' || lpad(CAST(10 + c_custkey % 9 AS VARCHAR), 2, '0') || '-08' AS period FROM customer GROUP BY 1")
def period_folders(t):
    p = F.concat(F.lit("/d/monthly/20"), F.lpad(text(10 + F.col("c_custkey") % 9), 2, "0"), F.lit("-08/x.xlsx"))
    return paths.periods(t.customer.select(p.alias("path")), "monthly")


@query("stored_keys", "SELECT p_partkey, 'portfolios/asof/2026-08-31/' || replace(p_brand, '#', '_') || '.json' AS key, '/api/amfi/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '?as_of=2026-08-31' ELSE '' END AS link FROM part")
def stored_keys(t):
    day = F.lit("2026-08-31").cast("date")
    return t.part.select("p_partkey", paths.asof_key(day, F.col("p_brand")).alias("key"), paths.api_link(text("p_partkey"), F.when(F.col("p_partkey") % 2 == 0, day)).alias("link"))


@query("scheme_master_lines", """
SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, 'Open Ended Schemes(' || CASE WHEN p_size > 25 THEN 'Debt' ELSE 'Equity' END || ')' AS category, p_brand || ' House' AS amc FROM part""")
def scheme_master_lines(t):
    """A master's text with category and house lines between its rows, split and read."""
    row = F.concat_ws(";", text("p_partkey"), F.lit("INF000000001"), F.lit("-"), "p_name", F.lit("10.5"), F.lit("31-Aug-2026"))
    lines = F.array(F.lit("Scheme Code;ISIN;ISIN;Scheme Name;Net Asset Value;Date"), F.concat(F.lit("Open Ended Schemes("), F.when(F.col("p_size") > 25, "Debt").otherwise("Equity"), F.lit(")")), F.lit(""), F.concat("p_brand", F.lit(" House")), row)
    df = t.part.select(text("p_partkey").alias("file"), F.posexplode(lines).alias("line_no", "line"))
    return schememaster.parse(df).select("code", "name", "category", "amc")


@query("plan_flags", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS direct, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false END AS growth, CASE p_partkey % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true END AS idcw FROM part")
def plan_flags(t):
    name = F.element_at(F.array(*[F.lit(x) for x in ("A Fund Direct Growth", "A Fund Regular IDCW", "A Fund - Direct Plan - Dividend Payout", "A Fund")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return t.part.select("p_partkey", schememaster.plan_flags(name).alias("f")).select("p_partkey", "f.*")


@query("json_trees", """
SELECT p_partkey AS id, unnest([0, 1]) AS pos, unnest(['Year ' || p_size, 'Year ' || p_size || '/Old']) AS path, unnest([p_name, 'x']) AS title, unnest(['/f/' || p_partkey || '.xlsx', '/o/' || p_partkey || '.pdf']) AS url FROM part""")
def json_trees(t):
    """Files of a nested listing inside a script, with the path of names above them."""
    tree = F.concat(F.lit('var rows = {"data":[{"name":"Year '), text("p_size"), F.lit('","items":[{"title":"'), F.col("p_name"), F.lit('","url":"/f/'), text("p_partkey"), F.lit('.xlsx"},{"name":"Old","list":[{"title":"x","path":"/o/'), text("p_partkey"), F.lit('.pdf"}]}]}]};'))
    return trees.files(t.part.select(F.col("p_partkey"), tree.alias("t")), "p_partkey", "t", "rows =")


# ---------------------------------------------------------------- serving


@query("book_route", """
WITH b AS (SELECT DISTINCT o_custkey AS k, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders), l AS (SELECT k, max(d) AS d FROM b GROUP BY k),
q AS (SELECT c_custkey AS k, c_custkey % 5 AS v, coalesce(l.d, NULL) AS latest FROM customer LEFT JOIN l ON l.k = c_custkey),
r AS (SELECT *, CASE v WHEN 0 THEN latest WHEN 1 THEN DATE '1996-08-31' WHEN 2 THEN DATE '1996-08-31' END AS day FROM q)
SELECT r.k AS request_id, CASE WHEN v = 3 THEN 'x' ELSE CAST(r.k + 10000 AS VARCHAR) END AS code, CASE WHEN v >= 3 THEN 400 WHEN b.k IS NULL THEN 404 ELSE 200 END AS status, CASE WHEN v < 3 AND p.k IS NOT NULL THEN '/api/amfi/' || (r.k + 10000) || '?as_of=' || CAST(p.d AS VARCHAR) END AS previous, CASE WHEN v < 3 AND b.k IS NOT NULL THEN '/api/amfi/' || (r.k + 10000) || '?as_of=' || CAST(b.d AS VARCHAR) END AS self, CASE WHEN v < 3 AND n.k IS NOT NULL THEN '/api/amfi/' || (r.k + 10000) || '?as_of=' || CAST(n.d AS VARCHAR) END AS next
FROM r LEFT JOIN b ON b.k = r.k AND b.d = r.day LEFT JOIN b p ON p.k = r.k AND p.d = last_day(date_trunc('month', r.day)::DATE - 1) LEFT JOIN b n ON n.k = r.k AND n.d = last_day((r.day + 1)::DATE)""")
def book_route(t):
    """Requests for the newest book, a dated one in two forms, with a bad code, with a bad date."""
    k = F.col("c_custkey")
    held = t.orders.select(F.concat(F.lit("p"), text("o_custkey")).alias("portfolio_id"), F.last_day(_date("o_orderdate")).alias("as_of")).distinct()
    newest = held.groupBy("portfolio_id").agg(F.max("as_of").alias("latest_as_of"))
    cat = t.customer.select(text(k + 10_000).alias("code"), F.concat(F.lit("p"), text(k)).alias("portfolio_id")).join(newest, "portfolio_id", "left")
    day = F.when(k % 5 == 1, "1996-08").when(k % 5 == 2, "31/08/1996").when(k % 5 == 4, "no day")
    req = t.customer.select(k.alias("request_id"), F.when(k % 5 == 3, "x").otherwise(text(k + 10_000)).alias("code"), day.alias("as_of"))
    return serving.answers(req, cat, held).select("request_id", "code", "status", "previous", "self", "next")


@query("scheme_route", "SELECT CAST(c_custkey + 10000 AS VARCHAR) AS code, c_name AS name FROM customer WHERE c_nationkey = 3 AND (contains(lower(c_name), '1') OR contains(CAST(c_custkey + 10000 AS VARCHAR), '1')) ORDER BY c_name LIMIT 5000")
def scheme_route(t):
    c = t.customer.select(text(F.col("c_custkey") + 10_000).alias("code"), F.col("c_name").alias("name"), text("c_nationkey").alias("amc_id"))
    return serving.schemes(c, "1", "3").select("code", "name")


@query("request_checks", "SELECT p_partkey, p_partkey % 5 IN (0, 1) AS code_ok, p_partkey % 5 IN (0, 4) AS key_ok FROM part")
def request_checks(t):
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t.part.select("p_partkey", serving.valid_code(pick("1234", "12345678", "123", "12a45", "123456789")).alias("code_ok"), serving.valid_key(pick("portfolios/asof/2026-08-31/x.json", "portfolios/../x.json", "etc/passwd", "secrets/x.json", "catalog/a.json")).alias("key_ok"))


@query("documented_views", "SELECT count(*) AS catalog, (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders) AS filings, (SELECT count(*) FROM orders) AS books FROM customer")
def documented_views(t):
    filings = t.orders.select(_date("o_orderdate").alias("as_of")).distinct()
    serving.register(t.spark, _catalog(t), filings, t.orders)
    return t.spark.sql("SELECT (SELECT count(*) FROM v_catalog) AS catalog, (SELECT count(*) FROM v_filings) AS filings, (SELECT count(*) FROM v_book) AS books")


# ---------------------------------------------------------------- runs


@query("files_to_do", "SELECT o_orderkey AS path FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def files_to_do(t):
    files = t.orders.select(F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("modified"))
    done = files.where("path % 3 > 0").select("path", F.when(F.col("path") % 5 == 0, F.col("modified") - F.expr("interval 1 day")).otherwise(F.col("modified")).alias("modified"))
    return increments.todo(files, done).select("path")


@query("rerun_window", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-06-01'")
def rerun_window(t):
    return increments.needs_rerun(t.orders.select("o_orderkey", _date("o_orderdate").alias("month")), "1997-07-20").select("o_orderkey")


@query("run_deltas", """
WITH b AS (SELECT o_custkey AS k, count(*) AS c FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1), a AS (SELECT o_custkey AS k, count(*) AS c FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
SELECT coalesce(b.k, a.k) AS k, coalesce(b.c, 0) AS before, coalesce(a.c, 0) AS after, coalesce(a.c, 0) - coalesce(b.c, 0) AS delta, CASE WHEN b.c IS NULL THEN 'new' WHEN a.c IS NULL THEN 'gone' WHEN a.c <> b.c THEN 'changed' ELSE 'same' END AS change FROM b FULL JOIN a ON a.k = b.k""")
def run_deltas(t):
    count = lambda where: t.orders.where(where).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("c"))
    return increments.deltas(count("o_orderstatus <> 'O'"), count("o_orderstatus <> 'F'"), "k", "c")


@query("month_unions", "SELECT ym, array_to_string(list_sort(list(p)), ',') AS periods FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y-%m') || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '-15' END AS p FROM orders) GROUP BY 1")
def month_unions(t):
    p = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise("-15"))
    return increments.month_groups(t.orders.select(p.alias("period")).distinct()).select("ym", F.array_join("periods", ",").alias("periods"))


_HOUSE_MONTHS = "SELECT DISTINCT c_nationkey AS house, date_trunc('month', o_orderdate)::DATE AS m FROM orders JOIN customer ON c_custkey = o_custkey"
_SLICES = "SELECT house, m + 14 AS as_of, 'fortnightly' AS cadence, 0 AS rank FROM m UNION ALL SELECT house, last_day(m), 'fortnightly', 1 FROM m UNION ALL SELECT house, last_day(m), 'monthly', 2 FROM m"


def _house_months(t) -> DataFrame:
    """The months in which each nation's customers ordered."""
    return t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("house"), F.trunc("o_orderdate", "MM").alias("m")).distinct()


@query("sync_order", f"WITH m AS ({_HOUSE_MONTHS}), s AS ({_SLICES}) SELECT house, CAST(as_of AS VARCHAR) AS as_of, cadence, row_number() OVER (PARTITION BY house ORDER BY rank, as_of)::BIGINT AS place FROM s")
def sync_order(t):
    """Each nation's months with orders, as slices in their safe order."""
    out = dates.in_sync_order(_house_months(t), ["house"])
    return out.select("house", text("as_of").alias("as_of"), "cadence", F.col("place").cast("long").alias("place"))


@query("job_matrix", f"""
WITH h AS ({_HOUSE_MONTHS}), w AS (SELECT house, min(m) AS a, max(m) AS b FROM h WHERE house % 2 = 0 OR month(m) > 6 GROUP BY house),
m AS (SELECT house, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM w), s AS ({_SLICES})
SELECT house, CAST(as_of AS VARCHAR) AS as_of, cadence, row_number() OVER (PARTITION BY house ORDER BY as_of, rank)::BIGINT AS place FROM s""")
def job_matrix(t):
    """Fetch jobs of each nation's window of months, from its first orders to its last."""
    windows = _house_months(t).where("house % 2 = 0 or month(m) > 6").groupBy("house").agg(F.date_add(F.min("m"), 4).alias("first"), F.last_day(F.max("m")).alias("last"))
    return increments.jobs(windows, ["house"]).select("house", text("as_of").alias("as_of"), "cadence", F.col("place").cast("long").alias("place"))


@query("snapshot_pick", "WITH c AS (SELECT o_orderpriority AS f, count(*) AS n FROM orders GROUP BY 1) SELECT o_orderkey FROM orders WHERE o_orderpriority = (SELECT f FROM c ORDER BY n DESC, f DESC LIMIT 1)")
def snapshot_pick(t):
    return increments.largest_snapshot(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("file"))).select("o_orderkey")


@query("mega_skip", "SELECT p_partkey FROM (SELECT *, bool_or(p_partkey % 4 > 0) OVER (PARTITION BY p_brand) AS other FROM part) WHERE p_partkey % 4 > 0 OR NOT other")
def mega_skip(t):
    f = F.concat(F.when(F.col("p_partkey") % 4 == 0, "Consolidated ").otherwise("Fund "), text("p_partkey"), F.lit(".xlsx"))
    return increments.without_mega(t.part.select("p_partkey", "p_brand", f.alias("path")), "p_brand", "path").select("p_partkey")


@query("size_samples", "WITH r AS (SELECT p_partkey, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size, p_partkey)) SELECT p_partkey FROM r WHERE i = 0 OR i = n // 2")
def size_samples(t):
    return increments.smallest_and_median(t.part.select("p_partkey", "p_brand", "p_size"), "p_brand", "p_partkey", "p_size").select("p_partkey")


@query("swapped_columns", "SELECT p_partkey FROM part WHERE p_partkey % 4 IN (1, 2)")
def swapped_columns(t):
    k = F.col("p_partkey") % 4
    plans = t.part.select("p_partkey", F.when(k == 1, "INF123456781").otherwise("10.5").alias("nav"), F.when(k == 2, "10.5").otherwise("INF123456781").alias("isin"))
    return guards.swapped_columns(plans).select("p_partkey")


@query("gap_severity", "SELECT o_custkey, CASE WHEN count(*) > 20 THEN 'fail' WHEN count(*) > 5 THEN 'warn' ELSE 'ok' END AS level FROM orders GROUP BY 1")
def gap_severity(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", guards.severity(F.col("n"), 5, 20).alias("level"))


_READERS = ", ".join(f"({i}, '{v[0]}')" for i, v in enumerate(connectors.HOUSES.values()))


@query("connector_stats", rf"""
WITH h(i, reader) AS (VALUES {_READERS}), p AS (SELECT page_id % {len(connectors.HOUSES) + 2} AS i, len(regexp_extract_all(html, '<a\s')) AS links FROM pages)
SELECT coalesce(reader, 'none') AS reader, count(DISTINCT p.i) AS houses, count(*) AS pages, sum(links)::BIGINT AS links FROM p LEFT JOIN h USING (i) GROUP BY 1""")
def connector_stats(t):
    """Landed pages by the kind of their house's listing: houses, pages, links; two houses have no connector."""
    known = t.spark.createDataFrame([(i, v[0]) for i, v in enumerate(connectors.HOUSES.values())], "i long, reader string")
    pages = t.pages.select((F.col("page_id") % (len(connectors.HOUSES) + 2)).alias("i"), F.regexp_count("html", F.lit(r"<a\s")).cast("long").alias("links"))
    by = pages.join(F.broadcast(known), "i", "left").groupBy(F.coalesce("reader", F.lit("none")).alias("reader"))  # a row a house
    return by.agg(F.count_distinct("i").alias("houses"), F.count("*").alias("pages"), F.sum("links").alias("links"))


@query("scored_listing", """
WITH l AS (SELECT page_id, page_id % 5 AS amc, page_id % 4 AS v FROM pages)
SELECT amc AS amc_id, arg_min(page_id, (CASE v WHEN 0 THEN -6 WHEN 1 THEN -4 WHEN 2 THEN -1 ELSE 3 END)::BIGINT * 1000000000 + page_id) AS ordinal FROM l GROUP BY amc""")
def scored_listing(t):
    """The best-scoring file of a month."""
    k = F.col("page_id")
    words = F.element_at(F.array(F.lit("monthly portfolio"), F.lit("portfolio"), F.lit("revised book"), F.lit("debt book")), (k % 4 + 1).cast("int"))
    rows = t.pages.select((k % 5).alias("amc_id"), k.alias("ordinal"), F.concat(F.lit("https://h.org/"), F.lpad(text(k), 9, "0"), F.lit(".xlsx")).alias("url"), F.concat(words, F.lit(" Aug 2026")).alias("title"))
    return listings.select(rows, listings.POLICIES["scored"]).select("amc_id", "ordinal")


@query("next_month_links", "SELECT page_id AS ordinal, 'https://h.org/September/2026/' || page_id || '.xlsx' AS url, '2026-09-01' AS month FROM pages")
def next_month_links(t):
    rows = t.pages.select(F.lit(1).alias("amc_id"), F.col("page_id").alias("ordinal"), F.concat(F.lit("https://h.org/August/2026/"), text("page_id"), F.lit(".xlsx")).alias("url"), F.lit("2026-08-01").cast("date").alias("month"))
    return connectors.derive_next_month(rows).select("ordinal", "url", text("month").alias("month"))


@query("wide_month_rows", "SELECT p_partkey, 'jan' AS month_name, 'u' || p_partkey AS url FROM part UNION ALL SELECT p_partkey, 'feb', 'v' FROM part WHERE p_partkey % 2 = 0")
def wide_month_rows(t):
    wide = t.part.select("p_partkey", F.concat(F.lit("u"), text("p_partkey")).alias("jan"), F.when(F.col("p_partkey") % 2 == 0, "v").otherwise("").alias("feb"))
    return connectors.wide_months(wide, "p_partkey")


@query("listing_plugin", """
SELECT 'h' || (page_id % 5) AS house, '2026-0' || (page_id % 4 + 1) AS period, page_id AS ordinal, url, CASE WHEN page_id % 3 > 0 THEN 'Portfolio ' || page_id END AS title
FROM pages WHERE url <> '' AND page_id % 4 IN (1, 2) AND page_id % 5 > 0 AND page_id % 3 > 0""")
def listing_plugin(t):
    """Listings landed by house and period, read through the registered source for two periods and all houses but one: files of other folders aren't opened."""
    from ..sources import plugin

    path = _place(t, "listings")
    k = F.col("page_id")
    rows = t.pages.select(F.concat(F.lit("h"), k % 5).alias("house"), F.lit("monthly").alias("cadence"), F.concat(F.lit("2026-0"), k % 4 + 1).alias("period"), k.alias("ordinal"), "url", F.when(k % 3 > 0, F.concat(F.lit("Portfolio "), k)).alias("title"))
    rows.write.partitionBy("house", "cadence", "period").json(path)
    plugin.register(t.spark)
    got = t.spark.read.format("ledger_listing").load(path).where("period in ('2026-02', '2026-03') and house > 'h0' and title is not null")
    return got.select("house", "period", "ordinal", "url", "title")


@query("published_versions", """
WITH b AS (SELECT o_custkey AS id, o_orderkey, year(o_orderdate) AS y FROM orders),
v AS (SELECT unnest([1, 2, 3]) AS version)
SELECT version::BIGINT AS version, count(*) AS books, count(DISTINCT id) AS ids, max(y)::BIGINT AS newest, CASE WHEN version = 1 THEN 0 ELSE (SELECT count(*) FROM b WHERE y >= 1996 AND id % 2 = 0) END::BIGINT AS notes
FROM v JOIN b ON y <= CASE version WHEN 1 THEN 1995 WHEN 2 THEN 1996 ELSE 1997 END GROUP BY version""")
def published_versions(t):
    """Books published in three versions, the last after a publication that crashed before its commit; each version read on its own."""
    root = _place(t, "published")
    o = t.orders.select(F.col("o_custkey").alias("id"), "o_orderkey", F.year("o_orderdate").cast("long").alias("y"))
    manifest.publish({"books": o.where("y <= 1995")}, root, partition_by={"books": ["y"]})
    manifest.publish({"books": o.where("y <= 1996"), "notes": o.where("y >= 1996 and id % 2 = 0")}, root)
    manifest.stage({"books": o.limit(0), "notes": o.limit(0)}, root)  # never committed
    manifest.publish({"books": o.where("y <= 1997")}, root)
    out = None
    for v in manifest.versions(t.spark, root):
        tables = manifest.pinned(t.spark, root, v)
        notes = tables["notes"].agg(F.count("*").alias("notes")) if "notes" in tables else t.spark.range(1).select(F.lit(0).cast("long").alias("notes"))
        one = tables["books"].agg(F.count("*").alias("books"), F.count_distinct("id").alias("ids"), F.max(F.col("y").cast("long")).alias("newest")).crossJoin(notes).withColumn("version", F.lit(v).cast("long"))  # one row by one
        out = one if out is None else out.unionByName(one)
    return out


@query("json_dimension", "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation")
def json_dimension(t):
    """A registry document of entries, written and read as rows."""
    path = _place(t, "registry")
    whole = t.nation.agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("amcs"))).alias("value"))  # 25 rows by the schema
    whole.coalesce(1).write.text(path)
    return paths.dimension(t.spark, path, "amcs").select("id", "name")


@query("bad_lines_skipped", "SELECT p_partkey AS code, p_name AS name FROM part WHERE p_partkey % 5 > 0")
def bad_lines_skipped(t):
    """A line-by-line checkpoint of which a fifth of the lines is cut off."""
    path = _place(t, "lines")
    line = F.to_json(F.struct(F.col("p_partkey").alias("code"), F.col("p_name").alias("name")))
    t.part.select(F.when(F.col("p_partkey") % 5 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    return increments.checkpoint_lines(t.spark, path, "code long, name string")


@query("month_upserts", "SELECT strftime(o_orderdate, '%Y-%m') AS slice, o_custkey AS k, max(o_orderkey) AS v FROM orders GROUP BY 1, 2")
def month_upserts(t):
    """Orders in two files, the later one's rows replacing those of equal customer and month."""
    from ..streaming import events as S

    base = _place(t, "upserts")
    o = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("slice"), F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    last = o.groupBy("slice", "k").agg(F.max("v").alias("v"), F.min("v").alias("w"))
    last.select("slice", "k", F.col("w").alias("v")).coalesce(1).write.parquet(f"{base}/in")
    S.upsert_batches(S.source(t.spark, f"{base}/in", "slice string, k long, v long", 1), f"{base}/out", f"{base}/state", "k", "slice")
    last.select("slice", "k", "v").coalesce(1).write.mode("append").parquet(f"{base}/in")
    S.upsert_batches(S.source(t.spark, f"{base}/in", "slice string, k long, v long", 1), f"{base}/out", f"{base}/state", "k", "slice")
    return t.spark.read.parquet(f"{base}/out").select(F.col("slice").cast("string").alias("slice"), "k", "v")


@query("nearest_members", "SELECT s_suppkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'add' ELSE 'bind' END AS action FROM supplier WHERE s_suppkey % 2 = 1")
def nearest_members(t):
    """Parents not known yet: bound to a label of their name, else to be added."""
    k = F.col("s_suppkey")
    name = F.concat(_word(k), F.lit(" "), F.reverse(_word(k)), F.lit(" Fund"))
    other = F.concat(F.lit("zz "), F.translate(text(k), "0123456789", "nopqrstvwx"), F.lit(" xx yy"))
    parents = t.supplier.select(k.alias("code"), k.alias("block"), name.alias("name"))
    labels = t.supplier.select(k.alias("label_id"), k.alias("block"), F.when(k % 3 == 0, other).otherwise(name).alias("label"))
    out = matching.new_parents(parents, parents.where("code % 2 = 0"), labels, labels.limit(0), "block")
    return out.select("code", "action")


@query("cascade_vias", """
SELECT p_partkey AS label_id, CASE p_partkey % 3 WHEN 0 THEN 'shortcode' WHEN 1 THEN 'direct' ELSE 'fuzzy' END AS via, p_partkey AS code FROM part""")
def cascade_vias(t):
    """How each label is bound: its short code, its key inside a name, or its likeness."""
    k = F.col("p_partkey")
    word = F.concat(_word(k), F.lit(" "), F.reverse(_word(k)))
    master = t.part.select(k.alias("code"), k.alias("block"), F.concat(word, F.lit(" Balanced Advantage Fund")).alias("name"))
    labels = t.part.select(k.alias("label_id"), k.alias("block"), F.when(k % 3 == 0, "unlike").when(k % 3 == 1, F.concat(word, F.lit(" Balanced Advantage"))).otherwise(F.concat(F.lit("Fund Advantage Balanced "), word)).alias("label"), F.concat(F.lit("s"), text(k)).alias("shortcode"))
    short = t.part.where("p_partkey % 3 = 0").select(k.alias("block"), F.concat(F.lit("S"), text(k)).alias("key"), k.alias("code"))
    return matching.cascade(labels, master, short, "block").where("via <> 'key_share'").select("label_id", "via", "code")
