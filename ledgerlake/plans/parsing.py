"""Queries from workbooks' bytes to books: files of six families are written from the tables and parsed again."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headers, names
from ..operators import compare, connectors, families, guards, indexes, rollups, serving
from ..sources import workbook
from .market import _INDEL
from .registry import query, real

_FAMILY_OF = ("sebi_title", "cams", "uti_mega", "tab", "tab_coded", "untabbed")
_HEADER = ["ISIN", "Industry", "Quantity", "Market Value (Rs. in Lakhs)", "% to NAV"]


def _sheet(kind: str, supplier: int, year: int, lines: pd.DataFrame) -> list[list]:
    """One scheme's rows as its family lays them out."""
    coded = kind in ("cams", "tab_coded")
    name = f"Supplier {supplier} {year} Growth Fund"
    top = [["SCHEME NAME :", name]] if kind == "cams" else [[f"SCHEME CODE {year} STARTS"], [f"SCHEME: {name}"]] if kind == "uti_mega" else [[name]]
    rows = [*top, [f"PORTFOLIO STATEMENT AS ON : 31-Dec-{year}"], [], ["Name of the Instrument", "", *_HEADER] if coded else ["Name of the Instrument", *_HEADER], ["Equity & Equity related"]]
    for x in lines.itertuples():
        own = [f"Part {x.l_partkey} of order {x.l_orderkey}", f"INE{x.l_orderkey * 8 + x.l_linenumber:09d}", "Trade", x.l_quantity, f"{x.l_extendedprice:.2f}", "0.5"]
        rows.append([f"C{x.l_linenumber}", *own] if coded else own)
    rows += [["Sub Total", "", "", "", f"{lines.l_extendedprice.sum():.2f}", "50"], ["GRAND TOTAL", "", "", "", f"{2 * lines.l_extendedprice.sum():.2f}", "100"]]
    if kind == "uti_mega":
        rows += [["Details of default beyond maturity"], ["Name of the Security", "ISIN", "Quantity", "Market Value", "% to NAV"], ["Lost Bond", "INE999A01019", "1", "1", "1"]]
    return rows


def _file(pdf: pd.DataFrame) -> pd.DataFrame:
    """A supplier's lines as a file of its house's family: a scheme for each year."""
    supplier = int(pdf.l_suppkey.iloc[0])
    kind = _FAMILY_OF[supplier % 6]
    by_year = [(int(y), g.sort_values(["l_orderkey", "l_linenumber"])) for y, g in sorted(pdf.groupby("year"))]
    tables = [(y, _sheet(kind, supplier, y, g)) for y, g in by_year]
    folder = f"/landed/house-{supplier % 6}/monthly/2026-03"
    if kind == "uti_mega":
        content = workbook.book_bytes([("Sebi Exposure", [r for _, t in tables for r in t])])
    elif kind == "sebi_title":
        # a thin sheet of the same code, a contents sheet, a consolidated pack and a marketing pack besides
        thin = [(f"Cap {y}", [[f"SF{y}"], *t[:6]]) for y, t in tables]
        book = workbook.book_bytes([("Index", [["1", "contents"]]), *thin, *[(f"SF{y}", t) for y, t in tables]])
        other = workbook.book_bytes([("SF1900", tables[0][1])])
        content = workbook.archive_bytes([("All Schemes.xlsx", other), ("Top 10 Holdings.xlsx", other), (f"Supplier {supplier}.xlsx", book), (".hidden.xlsx", b"")])
        return pd.DataFrame({"path": [f"{folder}/Supplier {supplier}.zip"], "content": [content]})
    else:
        front = [("Contents", [["1", "2"]])] if kind in ("cams", "tab_coded") else []
        content = workbook.book_bytes([*front, *[(f"T{y}", t) for y, t in tables]])
    return pd.DataFrame({"path": [f"{folder}/Supplier {supplier}.xlsx"], "content": [content]})


def landed_files(t) -> tuple[DataFrame, DataFrame]:
    """(files, houses): one file a supplier (30 years on: the parser knows years from 2000), whose houses use the six families, and a few files that no driver can take."""
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", (F.year("l_shipdate") + 30).alias("year"))
    files = lines.groupBy("l_suppkey").applyInPandas(_file, "path string, content binary")
    k = F.col("s_suppkey")
    odd = t.supplier.where(k % 10 == 0).select(
        F.when(k % 40 == 0, F.concat(F.lit("/landed/house-1/monthly/2026-03/Top 10 Holdings "), k, F.lit(".xlsx")))
        .when(k % 40 == 10, F.concat(F.lit("/landed/stranger/monthly/2026-03/"), k, F.lit(".xlsx")))
        .when(k % 40 == 20, F.concat(F.lit("/landed/house-3/monthly/2026-03/Broken "), k, F.lit(".xlsx")))
        .otherwise(F.concat(F.lit("/landed/"), k, F.lit(".xlsx")))
        .alias("path"),
        F.encode(F.col("s_name"), "utf-8").alias("content"),
    )
    every = t.spark.createDataFrame([(f"house-{i}", f, f == "tab_coded", True, True) for i, f in enumerate(_FAMILY_OF)], families.HOUSE)
    return files.unionByName(odd), every


_BOOKS_SQL = """
SELECT 'house-' || (l_suppkey % 6) AS house, 'Supplier ' || l_suppkey || ' ' || (year(l_shipdate) + 30) || ' Growth Fund' AS scheme,
  CASE l_suppkey % 6 WHEN 0 THEN 'SF' || (year(l_shipdate) + 30) WHEN 2 THEN NULL WHEN 5 THEN NULL ELSE 'T' || (year(l_shipdate) + 30) END AS shortcode,
  (year(l_shipdate) + 30) || '-12-31' AS as_of, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value, min('Part ' || l_partkey || ' of order ' || l_orderkey) AS least, count(DISTINCT CASE WHEN l_suppkey % 6 IN (1, 4) THEN 'C' || l_linenumber END) AS codes
FROM lineitem GROUP BY l_suppkey, (year(l_shipdate) + 30)"""


@query("family_books", _BOOKS_SQL)
def family_books(t):
    """Every supplier's file through its family's driver: the books' heads, and what their holdings sum to."""
    files, houses = landed_files(t)
    got = families.parse(files, houses)
    number = lambda c, kind: F.regexp_replace(c, ",", "").cast(kind)
    held = got.holdings.groupBy("file", "sheet_no", "block").agg(F.sum(number("quantity", "decimal(18,2)")).cast("long").alias("quantity"), real(F.sum(number("market_value", "decimal(18,2)"))).alias("value"), F.min("instrument").alias("least"), F.count_distinct("security_code").alias("codes"))
    return got.books.join(held, ["file", "sheet_no", "block"]).select("house", "scheme", "shortcode", F.col("as_of").cast("string").alias("as_of"), F.col("n_holdings").alias("n"), "quantity", "value", "least", "codes")


@query("family_rejects", """
SELECT CASE WHEN s_suppkey % 40 = 0 THEN 'a marketing pack' WHEN s_suppkey % 40 = 10 THEN 'no driver for its house' WHEN s_suppkey % 40 = 20 THEN 'BadZipFile: File is not a zip file' ELSE 'no house in its path' END AS reason, count(*) AS n
FROM supplier WHERE s_suppkey % 10 = 0 GROUP BY 1""")
def family_rejects(t):
    """Files that no driver takes, with the reason."""
    files, houses = landed_files(t)
    return families.rejected(files, houses).groupBy("reason").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- vendor comparison

_SORTED = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"

_VENDOR_SQL = rf"""
WITH RECURSIVE o AS (
  SELECT l_orderkey AS book, l_orderkey * 100 + l_linenumber * 10 AS id, p_name || ' ' || lower(p_type) || ' series ' || (p_size % 4) AS name, l_quantity / 10 AS w, p_partkey % 6 AS v
  FROM lineitem JOIN part ON p_partkey = l_partkey),
o2 AS (SELECT *, id + row_number() OVER (PARTITION BY id ORDER BY w, v, name) - 1 AS u FROM o),
th AS (
  SELECT book, u AS id, CASE v WHEN 1 THEN array_to_string(list_reverse(string_split(name, ' ')), ' ') WHEN 2 THEN substr(name, 2) WHEN 3 THEN name || 's' WHEN 4 THEN 'x' || reverse(name) ELSE name END AS name, CASE WHEN v = 3 THEN w * 2 WHEN v = 4 AND book % 2 = 0 THEN 0.01 ELSE w END AS w
  FROM o2 WHERE v < 5),
a AS (SELECT book, u AS id, name, w, row_number() OVER (PARTITION BY book, name ORDER BY u) AS nth FROM o2),
b AS (SELECT book, id, name, w, row_number() OVER (PARTITION BY book, name ORDER BY id) AS nth FROM th),
eq AS (SELECT a.book, a.id, b.id AS other FROM a JOIN b USING (book, name, nth)),
la AS (SELECT a.book, a.id, {_SORTED.format("a.name")} AS s FROM a WHERE a.id NOT IN (SELECT id FROM eq)),
lb AS (SELECT b.book, b.id, {_SORTED.format("b.name")} AS s FROM b WHERE b.id NOT IN (SELECT other FROM eq)),
words AS (SELECT la.s AS x, lb.s AS y FROM la JOIN lb USING (book) GROUP BY ALL),
scored AS (SELECT x, y, {_INDEL.format(a="x", b="y")} AS score FROM words),
e AS (
  SELECT book, la.id AS id, lb.id AS other, score, row_number() OVER (PARTITION BY book ORDER BY score DESC, la.id, lb.id) AS n
  FROM la JOIN lb USING (book) JOIN scored ON x = la.s AND y = lb.s WHERE score >= 88),
g AS (
  SELECT DISTINCT book, 0::BIGINT AS n, []::BIGINT[] AS used, []::BIGINT[] AS taken, NULL::BIGINT AS id, NULL::BIGINT AS other FROM e
  UNION ALL
  SELECT g.book, e.n, CASE WHEN free THEN list_append(used, e.id) ELSE used END, CASE WHEN free THEN list_append(taken, e.other) ELSE taken END, CASE WHEN free THEN e.id END, CASE WHEN free THEN e.other END
  FROM g JOIN e ON e.book = g.book AND e.n = g.n + 1, LATERAL (SELECT NOT list_contains(g.used, e.id) AND NOT list_contains(g.taken, e.other) AS free)),
p AS (SELECT book, id, other, 100.0::DOUBLE AS score FROM eq UNION ALL SELECT e.book, e.id, e.other, e.score FROM g JOIN e USING (book, id, other) WHERE g.id IS NOT NULL)
SELECT coalesce(a.book, b.book) AS book, a.id AS ours, b.id AS theirs, round(p.score, 6) AS score,
  CASE WHEN b.id IS NULL THEN 'ours_only' WHEN a.id IS NULL AND abs(b.w) < 0.05 THEN 'negligible' WHEN a.id IS NULL THEN 'theirs_only' WHEN abs(a.w - b.w) <= 0.35 OR abs(a.w - b.w) / greatest(abs(b.w), 0.2) <= 0.15 THEN 'match' ELSE 'off' END AS status
FROM a LEFT JOIN p ON p.id = a.id FULL JOIN b ON b.id = p.other"""


@query("vendor_compare", _VENDOR_SQL)
def vendor_compare(t):
    """Orders as books, lines as holdings; the vendor turns, cuts or lengthens some names, renames or drops others, and states other weights. Names of one book compete."""
    name = F.concat_ws(" ", "p_name", F.lower("p_type"), F.lit("series"), F.col("p_size") % 4)
    o = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_orderkey").alias("book"), (F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10).alias("id"), name.alias("name"), (F.col("l_quantity") / 10).alias("weight"), (F.col("p_partkey") % 6).alias("v"))
    o = o.repartition("book").withColumn("id", F.col("id") + F.row_number().over(Window.partitionBy("book", "id").orderBy("weight", "v", "name")) - 1)  # an id is of one book
    v = F.col("v")
    said = F.when(v == 1, F.array_join(F.reverse(F.split("name", " ")), " ")).when(v == 2, F.substr("name", F.lit(2))).when(v == 3, F.concat("name", F.lit("s"))).when(v == 4, F.concat(F.lit("x"), F.reverse("name"))).otherwise(F.col("name"))
    weight = F.when(v == 3, F.col("weight") * 2).when((v == 4) & (F.col("book") % 2 == 0), 0.01).otherwise(F.col("weight"))
    theirs = o.where("v < 5").select("book", "id", said.alias("name"), weight.alias("weight"))
    return compare.vendor_compare(o, theirs, "book").select("book", "ours", "theirs", F.round("score", 6).alias("score"), "status")


# ---------------------------------------------------------------- header tables and index sheets

_STEMS = ("Sr No", "Name of the Instrument", "ISIN Code", "Coupon", "YTM %", "Yield to Call", "Yield", "Residual", "Maturity Date", "Face Value", "Put / Call", "Industry / Rating", "Credit Rating", "Rating Agency", "Sector", "Quantity", "Futures Price", "Market Value (Rs. in Lakhs)", "% to NAV", "Macaulay", "Modified Duration", "Duration", "Unlisted", "Exchange", "NSE Code", "Accrued Interest", "Dirty Price", "Asset Class", "Scheme Name", "Long / Short", "Margin", "Market Capital", "Underlying", "Trade Date", "Settlement Date", "Remarks", "ESG", "null", "col_3", "Units", "Yield to maturity", "12")
_HEADS = "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN stem || ' ' || p_name WHEN p_partkey % 5 = 1 THEN p_name || ' ' || stem WHEN p_partkey % 5 = 2 THEN upper(stem) || ' :' ELSE stem END AS h FROM (SELECT *, [{stems}][(p_partkey + p_size) % {n} + 1] AS stem FROM part)".format(stems=", ".join(f"'{s}'" for s in _STEMS), n=len(_STEMS))
_CLEAN = r"regexp_replace(trim(regexp_replace(h, '\s+', ' ', 'g')), '^[.:*|]+|[.:*|]+$', '', 'g')"


def _rule(field: str, pattern: str) -> str:
    """DuckDB's expressions don't look behind: maturity after "to " is taken out first."""
    if "(?<!to )" in pattern:
        return f"WHEN regexp_matches(replace(lower(c), 'to maturity', 'to'), '{pattern.replace('(?<!to )', '')}') THEN '{field}'"
    return f"WHEN regexp_matches(c, '{pattern}', 'i') THEN '{field}'"


@query("universal_headers", f"""
WITH h AS ({_HEADS}), c AS (SELECT p_partkey, {_CLEAN} AS c FROM h)
SELECT p_partkey, c AS header, CASE WHEN c = '' OR regexp_matches(c, '^col(_\\d+)?$', 'i') OR lower(c) = 'null' THEN 'blank' {_rule('ignore', headers.IGNORED)} {' '.join(_rule(k, p) for k, p in headers.UNIVERSAL.items())} ELSE 'unmapped' END AS field FROM c""")
def universal_headers(t):
    """Headers made of known words and parts' names, by the table of all fields."""
    return _heads(t).select("p_partkey", headers.clean_header(F.col("h")).alias("header"), headers.universal_field(F.col("h")).alias("field"))


def _heads(t) -> DataFrame:
    stem = F.element_at(F.array(*map(F.lit, _STEMS)), ((F.col("p_partkey") + F.col("p_size")) % len(_STEMS) + 1).cast("int"))
    k = F.col("p_partkey") % 5
    h = F.when(k == 0, F.concat_ws(" ", stem, "p_name")).when(k == 1, F.concat_ws(" ", "p_name", stem)).when(k == 2, F.concat(F.upper(stem), F.lit(" :"))).otherwise(stem)
    return t.part.select("p_partkey", h.alias("h"))


@query("index_pairs", """
SELECT s_nationkey::VARCHAR AS file, CASE s_nationkey % 3 WHEN 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'S' || s_suppkey ELSE (s_suppkey + 10)::VARCHAR END WHEN 1 THEN 'S' || s_suppkey ELSE 'F' || s_suppkey END AS code, s_name || ' Fund' AS name
FROM supplier WHERE s_suppkey % 11 > 0""")
def index_pairs(t):
    """A contents sheet for each nation with its suppliers as funds: codes with short ones, short names alone, or codes whose header stands in an earlier row; rows without a name don't count."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey") % 3
    row = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    name = F.when(k % 11 > 0, F.concat(F.regexp_replace("s_name", " ", "  "), F.lit("  Fund "))).otherwise("")
    short = F.when((n == 0) & (k % 2 > 0), "").otherwise(F.concat(F.lit("S"), k))
    cells = F.when(n == 0, F.array((k + 10).cast("string"), name, short)).when(n == 1, F.array(F.lit(""), short, name)).otherwise(F.array(F.concat(F.lit("F"), k), F.lit("x"), name))
    body = t.supplier.select(F.col("s_nationkey").cast("string").alias("file"), (row + 2).alias("row_no"), cells.alias("cells"))
    heads = {0: [["House"], [], ["Fund Code", " Scheme Name ", "Short Code"]], 1: [["1"], ["2"], ["", "SHORT NAME", "Fund Name"]], 2: [["Code"], ["Scheme names of the house"], ["", "", "Fund Description"]]}
    own = F.array(*[F.array(*[F.array(*[F.lit(c) for c in r]).cast("array<string>") for r in heads[i]]) for i in range(3)])
    top = t.nation.select(F.col("n_nationkey").cast("string").alias("file"), F.posexplode(F.element_at(own, (F.col("n_nationkey") % 3 + 1).cast("int"))).alias("row_no", "cells"))
    grid = body.unionByName(top).withColumn("sheet", F.lit("Index"))
    return indexes.index_pairs(grid).select("file", "code", "name")


@query("scheme_rows", r"""
SELECT CASE l_suppkey % 3 WHEN 0 THEN 'Fund ' || l_linenumber || ' of ' || l_suppkey WHEN 1 THEN 'Sheet ' || l_suppkey ELSE 'Sheet ' || l_suppkey END AS scheme, count(*) AS n, sum(l_quantity)::BIGINT AS quantity, min('Part ' || l_partkey) AS least
FROM lineitem GROUP BY 1""")
def scheme_rows(t):
    """A sheet for each supplier whose lines are rows: with a scheme column, without one, or with totals and one-cell rows between."""
    s = F.col("l_suppkey")
    row = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber"))
    part, quantity, value = F.concat(F.lit("Part "), "l_partkey"), F.col("l_quantity").cast("long").cast("string"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    cells = F.when(s % 3 == 0, F.array(F.concat(F.lit("Fund "), "l_linenumber", F.lit(" of "), s), part, quantity, value)).otherwise(F.array(part, F.lit(""), quantity, value))
    lines = t.lineitem.select(s, (row * 2 + 2).alias("row_no"), cells.alias("cells"))
    between = t.lineitem.where(s % 3 == 2).select(s, (row * 2 + 3).alias("row_no"), F.when(row % 3 == 0, F.array(F.lit("Total"), F.lit(""), quantity, F.lit(""))).when(row % 3 == 1, F.array(part)).otherwise(F.array(F.lit("-"), F.lit("Sub Total"))).alias("cells"))
    head = F.when(F.col("s_suppkey") % 3 == 0, F.array(*map(F.lit, ("Scheme", "Name of the Security", "Quantity", "Market Value (Rs)")))).otherwise(F.array(*map(F.lit, ("Security", "", "Qty", "Market Value (Rs)"))))
    top = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.lit(2).alias("row_no"), head.alias("cells"))
    grid = lines.unionByName(between).unionByName(top).withColumn("file", F.concat(F.lit("/x/File "), s, F.lit(".xlsx"))).withColumn("sheet", F.concat(F.lit("Sheet "), s))
    got = indexes.scheme_rows(grid)
    return got.groupBy("scheme").agg(F.count("*").alias("n"), F.sum(F.col("fields")["quantity"].cast("long")).alias("quantity"), F.min(F.col("fields")["instrument"]).alias("least"))


# ---------------------------------------------------------------- descriptions and match keys

_LABELS = """
SELECT p_partkey, p_name, CASE p_partkey % 9 WHEN 0 THEN p_name || ' Fund (An open ended equity scheme)' WHEN 1 THEN 'Monthly Portfolio  Statement of ' || p_name || ' Fund as on 31-Jul-2026' WHEN 2 THEN 'IB01 - ' || p_name || ' Fund (1879 DAYS)' WHEN 3 THEN p_name || ' Fund (formerly known as Old ' || p_name || ')'
  WHEN 4 THEN p_name || ' Fund - Unclaimed Redemption' WHEN 5 THEN p_name || ' Fund for June 2026' WHEN 6 THEN p_name || ' Fund (MOFUSTF' WHEN 7 THEN p_name || ' Fund - An open-ended scheme of ' || lower(p_type) ELSE 'Scheme Name:' END AS base,
  CASE p_partkey % 4 WHEN 0 THEN p_name || ' Fund April 2027 - Direct Plan - Growth' WHEN 1 THEN p_name || ' Fund Series ' || p_size || ' Regular Plan' WHEN 2 THEN 'Another Fund' END AS canonical FROM part"""


def _nested(sql: str, patterns) -> str:
    """DuckDB's removal of tails, one after another."""
    for p in patterns:
        sql = f"trim(regexp_replace({sql}, '{p}', ''))"
    return sql


def _described(x: str) -> str:
    of = f"regexp_extract({x}, '{names.STATEMENT_OF}', 1)"
    return _nested(f"CASE WHEN {of} <> '' THEN trim({of}, ' -') ELSE {_nested(x, names.DATE_TAILS)} END", names.DESCRIPTION_TAILS)


_SQUEEZED = r"trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'))"
_VARIANT_TAIL = r"(?i)\s*[-–(:]?\s*\b(?:" + "|".join(w.replace(" ", r"\s+") for w in names.VARIANT_WORDS) + r")s?\b.*$"
_NORM = "trim(regexp_replace(replace(lower({0}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_KEYS_SQL = f"""
WITH l AS ({_LABELS}),
s AS (SELECT *, {_SQUEEZED.format('base')} AS b, {_SQUEEZED.format(_nested("coalesce(canonical, '')", names.PLAN_TAILS))} AS c FROM l),
d AS (SELECT *, {_described('b')} AS bd, {_described('c')} AS cd FROM s),
n AS (SELECT *, CASE WHEN regexp_matches(bd, '{names.NO_NAME}') THEN '' ELSE bd END AS described, CASE WHEN regexp_matches(cd, '{names.NO_NAME}') THEN '' ELSE cd END AS canon FROM d),
v AS (SELECT *, coalesce(nullif(described, ''), base) AS x FROM n),
w AS (SELECT *, coalesce(nullif({_nested('x', [_VARIANT_TAIL] * 4)}, ''), x) AS y, coalesce(nullif({_nested('canon', [_VARIANT_TAIL] * 4)}, ''), canon) AS z, regexp_extract(coalesce(canonical, ''), '{names.MATURITY}', 1) AS month FROM v),
k AS (SELECT *, CASE WHEN NOT regexp_matches(y, '(?:19|20)\\d{{2}}') AND month <> '' THEN y || ' - ' || month ELSE y END AS dated FROM w),
r AS (SELECT *, replace({_NORM.format('dated')}, ' ', '') AS ra, replace({_NORM.format('z')}, ' ', '') AS rb FROM k)
SELECT p_partkey, described, coalesce(nullif({_NORM.format("CASE WHEN starts_with(rb, ra) AND ra <> '' AND length(rb) >= length(ra) + 3 THEN z ELSE dated END")}, ''), {_NORM.format('base')}) AS key FROM r"""


@query("match_keys", _KEYS_SQL)
def match_keys(t):
    """Parts' names inside the texts that labels put around them, and the keys by which funds of such names are matched."""
    k, n = F.col("p_partkey"), F.col("p_name")
    forms = [F.concat(n, F.lit(" Fund (An open ended equity scheme)")), F.concat(F.lit("Monthly Portfolio  Statement of "), n, F.lit(" Fund as on 31-Jul-2026")), F.concat(F.lit("IB01 - "), n, F.lit(" Fund (1879 DAYS)")), F.concat(n, F.lit(" Fund (formerly known as Old "), n, F.lit(")")), F.concat(n, F.lit(" Fund - Unclaimed Redemption")), F.concat(n, F.lit(" Fund for June 2026")), F.concat(n, F.lit(" Fund (MOFUSTF")), F.concat(n, F.lit(" Fund - An open-ended scheme of "), F.lower("p_type")), F.lit("Scheme Name:")]
    full = [F.concat(n, F.lit(" Fund April 2027 - Direct Plan - Growth")), F.concat(n, F.lit(" Fund Series "), F.col("p_size"), F.lit(" Regular Plan")), F.lit("Another Fund"), F.lit(None).cast("string")]
    of = lambda xs: F.element_at(F.array(*xs), (k % len(xs) + 1).cast("int"))
    p = t.part.select("p_partkey", of(forms).alias("base"), of(full).alias("canonical"))
    return p.select("p_partkey", names.strip_description(F.col("base")).alias("described"), names.match_key(F.col("base"), F.col("canonical")).alias("key"))


# ---------------------------------------------------------------- kept rollups, phantom runs, routes

_DAY = "CAST(l_shipdate AS DATE)"


@query("activity_rollup", f"SELECT l_suppkey, count(*) AS n, CAST(min({_DAY}) AS VARCHAR) AS first, CAST(max({_DAY}) AS VARCHAR) AS last, count(DISTINCT {_DAY}) AS days, true AS codes_near FROM lineitem GROUP BY 1")
def activity_rollup(t):
    """Each supplier's lines by month, kept; the months from 1998 come late and are counted again alone. The sketches' estimate lies within 6 % of the distinct parts."""
    day = F.to_date("l_shipdate")
    rows = t.lineitem.select("l_suppkey", day.alias("day"), F.col("l_partkey").alias("code"))
    period = F.trunc("day", "MM")
    early = rollups.states(rows.where("day < date'1998-01-01' or l_suppkey % 2 = 0"), ["l_suppkey"], period, "day", "code")
    late = rollups.states(rows.where("day >= date'1998-01-01'"), ["l_suppkey"], period, "day", "code")
    exact = rows.groupBy("l_suppkey").agg(F.count_distinct("code").alias("exact"))
    got = rollups.merged(rollups.refreshed(early, late), ["l_suppkey"]).join(exact, "l_suppkey")
    near = F.abs(F.col("codes") - F.col("exact")) <= 0.06 * F.col("exact")
    return got.select("l_suppkey", "n", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "days", near.alias("codes_near"))


@query("stamped_runs", """
WITH f AS (SELECT o_custkey % 40 AS run_id, DATE '1996-01-01' + CAST(o_custkey % 40 AS INTEGER) AS run_day, o_orderkey AS key, CASE WHEN o_custkey % 40 % 5 = 0 AND o_orderkey % 20 > 0 THEN DATE '1996-01-01' + CAST(o_custkey % 40 AS INTEGER) ELSE CAST(o_orderdate AS DATE) END AS as_of FROM orders),
r AS (SELECT run_id, count(*) AS keys, count(*) FILTER (WHERE as_of = run_day) AS stamped FROM f GROUP BY run_id)
SELECT f.run_id, count(*) AS kept, bool_or(keys >= 20 AND stamped >= 0.9 * keys) AS phantom FROM f JOIN r USING (run_id) WHERE NOT (keys >= 20 AND stamped >= 0.9 * keys AND as_of = run_day) OR key % 7 = 0 GROUP BY f.run_id""")
def stamped_runs(t):
    """Runs of filings, a fifth of which stamp their own day on nearly all keys; every seventh stamp has a book."""
    run = F.col("o_custkey") % 40
    run_day = F.date_add(F.lit("1996-01-01").cast("date"), run.cast("int"))
    f = t.orders.select(run.alias("run_id"), run_day.alias("run_day"), F.col("o_orderkey").alias("key"), F.when((run % 5 == 0) & (F.col("o_orderkey") % 20 > 0), run_day).otherwise(F.to_date("o_orderdate")).alias("as_of"))
    kept = guards.without_stamps(f, f.where("key % 7 = 0").select("key", "as_of"))
    return kept.groupBy("run_id").agg(F.count("*").alias("kept")).join(guards.stamped_runs(f).select("run_id", "phantom"), "run_id")


@query("holdings_route", """
WITH b AS (SELECT DISTINCT o_custkey AS k, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders), l AS (SELECT k, max(d) AS d FROM b GROUP BY k),
q AS (SELECT c_custkey AS k, c_custkey % 7 AS v, l.d FROM customer LEFT JOIN l ON l.k = c_custkey)
SELECT k AS request_id, CASE v WHEN 3 THEN 400 WHEN 4 THEN 404 WHEN 5 THEN 400 WHEN 6 THEN 404 ELSE CASE WHEN d IS NULL THEN 404 ELSE 200 END END AS status,
  CASE WHEN v < 3 AND d IS NOT NULL THEN '/api/amfi/' || (k + 10000) || '?as_of=' || CAST(d AS VARCHAR) END AS self FROM q""")
def holdings_route(t):
    """Requests by code, by key and by path, without any, with keys that aren't stored or of another form, and with a strange path."""
    k = F.col("c_custkey")
    held = t.orders.select(F.concat(F.lit("p"), "o_custkey").alias("portfolio_id"), F.last_day(F.to_date("o_orderdate")).alias("as_of")).distinct()
    newest = held.groupBy("portfolio_id").agg(F.max("as_of").alias("latest_as_of"))
    stored, path = F.concat(F.lit("portfolios/latest/"), k, F.lit(".json")), F.concat(F.lit("data/"), k, F.lit("/portfolio.json"))
    cat = t.customer.select((k + 10_000).cast("string").alias("code"), F.concat(F.lit("p"), k).alias("portfolio_id"), stored.alias("key"), path.alias("path")).join(newest, "portfolio_id", "left")
    v = k % 7
    key = F.when(v == 1, stored).when(v == 4, F.lit("portfolios/latest/none.json")).when(v == 5, F.lit("../etc/passwd"))
    req = t.customer.select(k.alias("request_id"), F.when(v == 0, (k + 10_000).cast("string")).otherwise("").alias("code"), key.alias("key"), F.when(v == 2, path).when(v == 6, F.lit("/etc/passwd")).alias("path"), F.lit(None).cast("string").alias("as_of"))
    return serving.holdings_answers(req, cat, held).select("request_id", "status", "self")


@query("scheme_search", """
WITH h AS (SELECT c_custkey AS code, c_name AS scheme, c_nationkey::VARCHAR AS amc_id, upper(c_mktsegment) AS shortcode, 'f' || (c_custkey % 100) AS folder FROM customer)
SELECT code, scheme, count(*) OVER () AS count, (SELECT array_to_string(list(k ORDER BY k), ',') FROM (SELECT c_custkey AS k FROM customer WHERE 'F' || (c_custkey % 100) = upper(h.folder)) ) AS codes FROM h WHERE contains(lower(scheme), 'f7') OR contains(lower(amc_id), 'f7') OR contains(lower(shortcode), 'f7') OR contains(lower(folder), 'f7') ORDER BY scheme LIMIT 5000""")
def scheme_search(t):
    """The comparison page's search over four columns, each hit with the codes that its folder's hint tells."""
    s = t.customer.select(F.col("c_custkey").alias("code"), F.col("c_name").alias("scheme"), F.col("c_nationkey").cast("string").alias("amc_id"), F.upper("c_mktsegment").alias("shortcode"), F.concat(F.lit("f"), F.col("c_custkey") % 100).alias("folder"))
    told = serving.hints(s.select(F.concat(F.lit(" "), "folder").alias("key"), F.col("code").cast("string").alias("code"), F.col("code").alias("ordinal")))
    found = serving.search(s, "F7 ").withColumn("key", F.upper("folder")).join(told, "key", "left")
    return found.select("code", "scheme", "count", F.array_join("codes", ",").alias("codes"))


# ---------------------------------------------------------------- houses' own filters

_SAYS = ("Monthly Portfolio", "Fortnightly Portfolio", "Fortnightly and monthly", "AAUM", "Half Year monthly portfolio", "Debt Schemes Portfolio", "weekly monthly", "Scheme Portfolio", "helios-fund", "monthly_portfolio", "")
_ENDS = (".xlsx", ".xls?v=1", ".zip", ".pdf", ".xlsb", "")
_RULED = ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in connectors.FILTERS)
_HOUSES = sorted({r[0] for r in connectors.FILTERS} | {"uti", "sbi"})


@query("house_filters", f"""
WITH rule(house, cadence, part, keep, stop, unless, files) AS (VALUES {_RULED}),
h AS (SELECT unnest([{', '.join(f"'{h}'" for h in _HOUSES)}]) AS house, unnest(range(0, {len(_HOUSES)})) AS n), c AS (SELECT unnest(['monthly', 'fortnightly']) AS cadence),
l AS (SELECT house, cadence, page_id AS ordinal, [{', '.join(f"'{x}'" for x in _SAYS)}][(page_id + n) % {len(_SAYS)} + 1] || CASE WHEN page_id % 3 = 0 THEN ' Aug 2026' ELSE '' END AS title,
  'https://h.org/' || CASE WHEN page_id % 4 = 0 THEN 'portfolios/' ELSE 'x/' END || CASE page_id % 5 WHEN 0 THEN '31082026_' WHEN 1 THEN 'halfyear-' ELSE '' END || replace(lower([{', '.join(f"'{x}'" for x in _SAYS)}][(page_id * 7 + n) % {len(_SAYS)} + 1]), ' ', '-') || page_id || [{', '.join(f"'{x}'" for x in _ENDS)}][(page_id * 5 + n) % {len(_ENDS)} + 1] AS url FROM pages, h, c),
j AS (SELECT l.*, part, keep, stop, unless, files, CASE part WHEN 'title' THEN title WHEN 'url' THEN url WHEN 'name' THEN regexp_extract(url, '([^/?#]+)(?:[?#].*)?$', 1) ELSE title || ' ' || url END AS said FROM l LEFT JOIN rule USING (house, cadence))
SELECT house, cadence, ordinal, title, url FROM j WHERE part IS NULL OR (regexp_matches(said, '(?i)' || keep) AND NOT (stop <> '' AND regexp_matches(said, '(?i)' || stop) AND NOT (unless <> '' AND regexp_matches(said, '(?i)' || unless))) AND regexp_matches(url, '(?i)' || files))""")
def house_filters(t):
    """Listings of houses with and without filters of their own, a row for each page, both cadences, all filtered in one pass."""
    k, n = F.col("page_id"), F.col("n")
    of = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i % len(xs) + 1).cast("int"))
    houses = F.array(*[F.struct(F.lit(h).alias("house"), F.lit(i).cast("long").alias("n")) for i, h in enumerate(_HOUSES)])
    rows = t.pages.select("page_id", F.explode(houses).alias("h")).select("page_id", "h.*", F.explode(F.array(F.lit("monthly"), F.lit("fortnightly"))).alias("cadence"))
    title = F.concat(of(_SAYS, k + n), F.when(k % 3 == 0, " Aug 2026").otherwise(""))
    url = F.concat(F.lit("https://h.org/"), F.when(k % 4 == 0, "portfolios/").otherwise("x/"), F.when(k % 5 == 0, "31082026_").when(k % 5 == 1, "halfyear-").otherwise(""), F.replace(F.lower(of(_SAYS, k * 7 + n)), F.lit(" "), F.lit("-")), k, of(_ENDS, k * 5 + n))
    listing = rows.select("house", "cadence", k.alias("ordinal"), title.alias("title"), url.alias("url"))
    return connectors.filtered(listing, connectors.filters(t.spark))
