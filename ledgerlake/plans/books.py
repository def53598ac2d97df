"""Queries over books made from the order tables: holder = supplier, date = ship month's end, instrument = part."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import books, catalog, compare, guards, picks
from .registry import joined, money, query, real, text

_BOOKS = """
d AS (SELECT l_suppkey AS pid, last_day(CAST(l_shipdate AS DATE)) AS as_of, l_partkey AS instrument, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
h AS (SELECT pid, as_of, instrument, sum(v) AS v FROM d GROUP BY ALL),
b AS (SELECT pid, as_of, count(*) AS n FROM h GROUP BY ALL)"""


def _holdings(t):
    d = t.lineitem.select(F.col("l_suppkey").alias("pid"), F.last_day(F.to_date("l_shipdate")).alias("as_of"), F.col("l_partkey").alias("instrument"), money("l_extendedprice").alias("v"))
    return d.groupBy("pid", "as_of", "instrument").agg(F.sum("v").alias("v"))


def _books(t):
    return t.lineitem.select(F.col("l_suppkey").alias("pid"), F.last_day(F.to_date("l_shipdate")).alias("as_of"), "l_partkey").groupBy("pid", "as_of").agg(F.countDistinct("l_partkey").alias("n"))


@query("latest_book_weights", f"""
WITH {_BOOKS}, l AS (SELECT pid, max(as_of) AS as_of FROM h GROUP BY pid),
w AS (SELECT h.*, sum(h.v) OVER (PARTITION BY h.pid) AS total FROM h JOIN l USING (pid, as_of))
SELECT w.pid AS holder, s.s_name AS holder_name, n.n_name AS nation, CAST(w.as_of AS VARCHAR) AS as_of, w.instrument, p.p_name AS instrument_name, CAST(w.v AS DOUBLE) AS market_value,
  CAST(round(CAST(w.v * 100 AS DECIMAL(28,8)) / w.total, 4) AS DECIMAL(18,4))::DOUBLE AS pct_nav, abs(sum(w.v) OVER (PARTITION BY w.pid) * 100 / w.total - 100) <= 0.1 AS sums_to_100
FROM w JOIN supplier s ON s.s_suppkey = w.pid JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN part p ON p.p_partkey = w.instrument
""")
def latest_book_weights(t):
    """The newest book of every holder with weights of book and the allocation check."""
    h = _holdings(t)
    newest = h.groupBy("pid").agg(F.max("as_of").alias("as_of"))
    w = h.join(newest, ["pid", "as_of"]).withColumn("total", F.sum("v").over(Window.partitionBy("pid")))
    w = w.withColumn("pct_nav", F.round(real(F.col("v") * 100) / real(F.col("total")), 4)).withColumn("share", F.col("v") * 100 / F.col("total"))
    w = w.withColumn("sums_to_100", books.meets_allocation(real(F.sum("share").over(Window.partitionBy("pid")))))
    w = w.join(t.supplier, w.pid == F.col("s_suppkey")).join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).join(t.part, F.col("p_partkey") == F.col("instrument"))
    return w.select(F.col("pid").alias("holder"), F.col("s_name").alias("holder_name"), F.col("n_name").alias("nation"), text("as_of").alias("as_of"), "instrument", F.col("p_name").alias("instrument_name"), real(F.col("v")).alias("market_value"), "pct_nav", "sums_to_100")


@query("asof_exact_lookup", f"""
WITH {_BOOKS} SELECT s.s_suppkey AS pid, coalesce(b.n, 0)::BIGINT AS n, CASE WHEN b.n IS NULL THEN 'No Data Found' ELSE 'ok' END AS status
FROM supplier s LEFT JOIN b ON b.pid = s.s_suppkey AND b.as_of = DATE '1996-03-31'""")
def asof_exact_lookup(t):
    """One date's book of every holder; no nearest date is taken."""
    b = _books(t).where(F.col("as_of") == F.lit("1996-03-31").cast("date"))
    out = t.supplier.select(F.col("s_suppkey").alias("pid")).join(b, "pid", "left")
    return out.select("pid", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.when(F.col("n").isNull(), "No Data Found").otherwise("ok").alias("status"))


@query("asof_nearest", f"""
WITH {_BOOKS}, q AS (SELECT s_suppkey AS pid, unnest([DATE '1994-02-10', DATE '1995-07-20', DATE '1997-12-01']) AS want FROM supplier)
SELECT q.pid, CAST(q.want AS VARCHAR) AS want, CAST(max(b.as_of) AS VARCHAR) AS as_of FROM q LEFT JOIN b ON b.pid = q.pid AND b.as_of <= q.want GROUP BY q.pid, q.want""")
def asof_nearest(t):
    """The newest book on or before each wanted date: keys meet by equality, the date bounds the rest."""
    b = _books(t).select("pid", F.col("as_of").alias("d"))
    want = F.array(*[F.lit(x).cast("date") for x in ("1994-02-10", "1995-07-20", "1997-12-01")])
    q = t.supplier.select(F.col("s_suppkey").alias("pid"), F.explode(want).alias("want"))
    out = q.join(b, (q.pid == b.pid) & (F.col("d") <= F.col("want")), "left").groupBy(q.pid, "want").agg(F.max("d").alias("d"))
    return out.select("pid", text("want").alias("want"), text("d").alias("as_of"))


@query("prev_next_filing_links", """
WITH d AS (SELECT DISTINCT CASE WHEN day(CAST(l_shipdate AS DATE)) <= 16 THEN date_trunc('month', l_shipdate)::DATE + 14 ELSE last_day(CAST(l_shipdate AS DATE)) END AS x FROM lineitem),
k AS (SELECT x, CASE WHEN day(x) = 15 THEN 'fortnightly' ELSE 'monthly' END AS cadence FROM d),
pn AS (SELECT x, cadence, (date_trunc('month', x) - INTERVAL 1 DAY)::DATE AS prev,
  CASE WHEN cadence = 'monthly' THEN last_day((date_trunc('month', x) + INTERVAL 1 MONTH)::DATE) ELSE last_day(x) END AS nxt FROM k)
SELECT CAST(x AS VARCHAR) AS as_of, cadence, CAST(prev AS VARCHAR) AS previous, prev IN (SELECT x FROM d) AS previous_exists, CAST(nxt AS VARCHAR) AS "next", nxt IN (SELECT x FROM d) AS next_exists FROM pn""")
def prev_next_filing_links(t):
    """Calendar neighbours of every filing date and whether they exist."""
    d = t.lineitem.select(dates.target_slice(F.to_date("l_shipdate")).alias("x")).distinct()
    k = d.withColumn("cadence", dates.cadence(F.col("x")))
    k = k.withColumn("p", dates.previous_filing(F.col("x"), F.col("cadence"))).withColumn("q", dates.next_filing(F.col("x"), F.col("cadence")))
    k = k.join(d.select(F.col("x").alias("p"), F.lit(True).alias("pe")), "p", "left").join(d.select(F.col("x").alias("q"), F.lit(True).alias("qe")), "q", "left")
    return k.select(text("x").alias("as_of"), "cadence", text("p").alias("previous"), F.coalesce("pe", F.lit(False)).alias("previous_exists"), text("q").alias("next"), F.coalesce("qe", F.lit(False)).alias("next_exists"))


@query("availability_array", f"WITH {_BOOKS} SELECT pid AS portfolio_id, array_to_string(list_transform(list_sort(list(as_of), 'DESC'), lambda x: CAST(x AS VARCHAR)), ',') AS available, CAST(max(as_of) AS VARCHAR) AS latest, count(*) AS n FROM b WHERE year(as_of) >= 1996 GROUP BY pid")
def availability_array(t):
    """Dates with a book, newest first: those advertised and those stored."""
    b = _books(t).withColumnRenamed("pid", "portfolio_id")
    advertised = b.where(F.year("as_of") >= 1996)
    out = catalog.availability(advertised, b)
    return out.select("portfolio_id", joined("available_as_of").alias("available"), text("latest_as_of").alias("latest"), F.size("available_as_of").cast("long").alias("n"))


@query("filings_index", f"WITH {_BOOKS} SELECT CAST(as_of AS VARCHAR) AS as_of, 'monthly' AS cadence, count(DISTINCT pid) AS portfolio_count FROM b GROUP BY as_of HAVING count(DISTINCT pid) >= 20")
def filings_index(t):
    """Books per date; sparse dates go."""
    out = catalog.filings(_books(t).withColumnRenamed("pid", "portfolio_id"), 20)
    return out.select(text("as_of").alias("as_of"), "cadence", "portfolio_count")


@query("latest_mirror", f"WITH {_BOOKS} SELECT pid, CAST(as_of AS VARCHAR) AS as_of, n FROM b QUALIFY row_number() OVER (PARTITION BY pid ORDER BY as_of DESC) = 1")
def latest_mirror(t):
    return catalog.newest(_books(t), "pid", "as_of").select("pid", text("as_of").alias("as_of"), "n")


@query("retention_window", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), m AS (SELECT max(d) AS m FROM o WHERE d = last_day(d))
SELECT year(d)::BIGINT AS y, month(d)::BIGINT AS mth, count(*) AS n FROM o, m WHERE d >= date_trunc('month', m.m - INTERVAL 11 MONTH) GROUP BY 1, 2""")
def retention_window(t):
    """The last twelve months, from the newest month-end back."""
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return catalog.retained(o, "d", 12).groupBy(F.year("d").cast("long").alias("y"), F.month("d").cast("long").alias("mth")).agg(F.count("*").alias("n"))


@query("merge_vs_replace_slice", """
WITH old AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey AS k, o_totalprice + 1 AS v FROM orders WHERE o_orderkey % 2 = 0)
SELECT 'merge' AS mode, count(*) AS n, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (SELECT * FROM new UNION ALL SELECT * FROM old WHERE k NOT IN (SELECT k FROM new))
UNION ALL SELECT 'replace', count(*), CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) FROM new""")
def merge_vs_replace_slice(t):
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    old, new = o.where("k % 3 <> 0"), o.where("k % 2 = 0").withColumn("v", F.col("v") + 1)
    parts = [catalog.write_slice(old, new, "k", m).agg(F.count("*").alias("n"), real(F.sum(money("v"))).alias("total")).select(F.lit(name).alias("mode"), "n", "total") for name, m in (("merge", True), ("replace", False))]
    return parts[0].unionByName(parts[1])


@query("phantom_links", """
WITH a AS (SELECT DISTINCT o_custkey AS pid, last_day(CAST(o_orderdate AS DATE)) AS as_of FROM orders),
b AS (SELECT DISTINCT o_custkey AS pid, last_day(CAST(l_shipdate AS DATE)) AS as_of FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT pid, CAST(as_of AS VARCHAR) AS as_of FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.pid = a.pid AND b.as_of = a.as_of)""")
def phantom_links(t):
    """Advertised dates without a book."""
    adv = t.orders.select(F.col("o_custkey").alias("pid"), F.last_day(F.to_date("o_orderdate")).alias("as_of"))
    real_ = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("pid"), F.last_day(F.to_date("l_shipdate")).alias("as_of"))
    return guards.phantom_dates(adv, real_, ["pid", "as_of"]).select("pid", text("as_of").alias("as_of"))


@query("coverage_gap", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def coverage_gap(t):
    return guards.uncovered(t.customer, t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey", "c_name")


@query("regression_guard", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n, count(*) FILTER (WHERE o_orderstatus <> 'F' OR o_orderkey % 5 > 0) AS k FROM orders GROUP BY 1)
SELECT ym, n AS before, k AS after FROM m WHERE k < n""")
def regression_guard(t):
    o = t.orders.withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    before, after = o.groupBy("ym").agg(F.count("*").alias("n")), o.where("o_orderstatus <> 'F' or o_orderkey % 5 > 0").groupBy("ym").agg(F.count("*").alias("n"))
    return guards.shrunken(before, after, "ym", "n")


@query("collapse_base_fund", """
WITH p AS (SELECT p_brand AS amc, split_part(p_type, ' ', 1) AS base, p_partkey AS code, p_size % 2 = 0 AS direct, p_size % 3 = 0 AS growth FROM part),
r AS (SELECT *, CASE WHEN direct AND growth THEN 0 WHEN NOT direct AND growth THEN 1 WHEN growth THEN 2 WHEN direct THEN 3 ELSE 4 END AS pref FROM p)
SELECT amc, base, count(*) AS n, bool_or(direct) AS any_direct, (array_agg(code ORDER BY pref, code))[1] AS canonical, array_to_string(list_sort(list(DISTINCT code)), ',') AS codes FROM r GROUP BY amc, base""")
def collapse_base_fund(t):
    """Plans collapsed to base funds with the preferred plan as canonical."""
    p = t.part.select(F.col("p_brand").alias("amc"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("base"), F.col("p_partkey").alias("code"), (F.col("p_size") % 2 == 0).alias("direct"), (F.col("p_size") % 3 == 0).alias("growth"))
    out = picks.collapse_group(p, ["amc", "base"], "code", picks.plan_preference(F.col("direct"), F.col("growth")), n=F.count("*"), any_direct=F.bool_or("direct"))
    return out.select("amc", "base", "n", "any_direct", "canonical", joined("codes").alias("codes"))


@query("canonical_member", """
WITH c AS (SELECT c_nationkey::BIGINT AS pid, c_custkey AS code FROM customer)
SELECT pid AS portfolio_id, coalesce(max(code) FILTER (WHERE code = pid), min(code)) AS canonical, count(DISTINCT code) AS n_members, array_to_string(list_sort(list(DISTINCT code)), ',') AS members FROM c GROUP BY pid""")
def canonical_member(t):
    c = t.customer.select(F.col("c_nationkey").cast("long").alias("portfolio_id"), F.col("c_custkey").alias("code"))
    return catalog.portfolio_index(c).select("portfolio_id", "canonical", "n_members", joined("members").alias("members"))


@query("richer_book_wins", """
WITH b AS (SELECT l_orderkey AS book, l_suppkey AS pid, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT pid, arg_max(book, n * 10000000 - book) AS first_wins, arg_max(book, n * 10000000 + book) AS last_wins, max(n) AS n FROM b GROUP BY pid""")
def richer_book_wins(t):
    """The book with the most rows; ties to the first or to the last."""
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("book"), F.col("l_suppkey").alias("pid")).agg(F.count("*").alias("n"))
    first = picks.keep_richest(b, "pid", "n", "book", last_wins=False).select("pid", F.col("book").alias("first_wins"), "n")
    last = picks.keep_richest(b, "pid", "n", "book", last_wins=True).select("pid", F.col("book").alias("last_wins"))
    return first.join(last, "pid")


@query("priority_lookup", """
WITH k AS (SELECT p_name AS key, min(p_partkey) AS v FROM part GROUP BY 1)
SELECT p.p_partkey, CASE WHEN a.v IS NOT NULL AND p.p_size > 25 THEN 0 WHEN b.v IS NOT NULL THEN 1 END AS matched_by, coalesce(CASE WHEN p.p_size > 25 THEN a.v END, b.v) AS resolved
FROM part p LEFT JOIN k a ON a.key = p.p_name LEFT JOIN (SELECT key, v FROM k WHERE v % 2 = 0) b ON b.key = p.p_name""")
def priority_lookup(t):
    """Candidate keys in order over one lookup; the first that hits."""
    k = t.part.groupBy(F.col("p_name").alias("key")).agg(F.min("p_partkey").alias("v"))
    look = k.select(F.concat(F.lit("a:"), "key").alias("key"), "v").unionByName(k.where("v % 2 = 0").select(F.concat(F.lit("b:"), "key").alias("key"), "v"))
    one = F.when(F.col("p_size") > 25, F.concat(F.lit("a:"), "p_name"))
    return picks.resolve_first(t.part.select("p_partkey", "p_name", "p_size"), "p_partkey", [one, F.concat(F.lit("b:"), "p_name")], look, "key", "v").select("p_partkey", "matched_by", "resolved")


@query("fill_from_alias", """
WITH c AS (SELECT c_custkey AS code, CASE WHEN c_custkey % 4 > 0 THEN c_nationkey END AS pid FROM customer), a AS (SELECT c_custkey AS orphan, c_custkey + 1 AS target FROM customer WHERE c_custkey % 2 = 0)
SELECT c.code, coalesce(c.pid, t.pid) AS portfolio_id, c.pid IS NULL AND t.pid IS NOT NULL AS inherited FROM c LEFT JOIN a ON a.orphan = c.code LEFT JOIN c t ON t.code = a.target""")
def fill_from_alias(t):
    c = t.customer.select(F.col("c_custkey").alias("code"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_nationkey")).alias("portfolio_id"))
    a = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("orphan"), (F.col("c_custkey") + 1).alias("target"))
    return catalog.inherit_alias(c, a)


@query("allocation_totals", """
WITH w AS (SELECT l_suppkey AS book, CAST(l_discount AS DECIMAL(38,10)) AS w, l_returnflag = 'A' AS f, l_returnflag = 'N' AS o FROM lineitem),
s AS (SELECT book, CAST(sum(w) AS DOUBLE) AS a, CAST(sum(w) FILTER (WHERE NOT f) AS DOUBLE) AS b, CAST(sum(w) FILTER (WHERE NOT o) AS DOUBLE) AS c, CAST(sum(w) FILTER (WHERE NOT f AND NOT o) AS DOUBLE) AS d, CAST(max(abs(w)) AS DOUBLE) AS top FROM w GROUP BY book),
k AS (SELECT *, coalesce(top <= 1.5 AND (coalesce(abs(a) BETWEEN 0.9 AND 1.1, false) OR coalesce(abs(b) BETWEEN 0.9 AND 1.1, false) OR coalesce(abs(c) BETWEEN 0.9 AND 1.1, false) OR coalesce(abs(d) BETWEEN 0.9 AND 1.1, false)), false) AS scaled FROM s)
SELECT book, scaled, CASE WHEN scaled THEN a * 100 ELSE a END AS t_all, CASE WHEN scaled THEN b * 100 ELSE b END AS t_no_futures, CASE WHEN scaled THEN c * 100 ELSE c END AS t_no_options, CASE WHEN scaled THEN d * 100 ELSE d END AS t_plain FROM k""")
def allocation_totals(t):
    """Four totals of each book under one scale."""
    w = t.lineitem.select(F.col("l_suppkey").alias("book"), F.col("l_discount").alias("w"), "l_returnflag")
    return books.allocation_totals(w, "book", "w", F.col("l_returnflag") == "A", F.col("l_returnflag") == "N")


@query("fraction_rescale", """
WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, l_discount AS w FROM lineitem),
s AS (SELECT *, max(abs(w)) OVER p AS top, CAST(sum(CAST(w AS DECIMAL(38,10))) OVER p AS DOUBLE) AS total FROM w WINDOW p AS (PARTITION BY book))
SELECT book, n, CASE WHEN top <= 1.5 AND abs(total) BETWEEN 0.90 AND 1.10 THEN w * 100 ELSE w END AS parser_w, CASE WHEN top <= 1.5 AND abs(total) BETWEEN 0.85 AND 1.15 THEN w * 100 ELSE w END AS contract_w, CASE WHEN top <= 1.5 THEN w * 100 ELSE w END AS qc_w FROM s""")
def fraction_rescale(t):
    """The separate detectors of fractions, side by side."""
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), F.col("l_discount").alias("w"))
    for name, detector in (("parser_w", books.parser_fraction), ("contract_w", books.contract_fraction), ("qc_w", books.qc_fraction)):
        w = w.withColumn(name, F.when(detector(F.col("w"), "book"), F.col("w") * 100).otherwise(F.col("w")))
    return w.drop("w")


@query("rebase_from_value", """
WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_discount * 100 AS w FROM lineitem),
s AS (SELECT *, CAST(sum(v) OVER p AS DOUBLE) AS total, CAST(sum(CAST(w AS DECIMAL(38,10))) OVER p AS DOUBLE) AS ws FROM w WINDOW p AS (PARTITION BY book))
SELECT book, n, CASE WHEN NOT abs(ws - 100) <= 0.1 THEN round(CAST(v AS DOUBLE) * 100 / (total * 1.0001), 6) ELSE round(w, 6) END AS w FROM s""")
def rebase_from_value(t):
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), real(money("l_extendedprice")).alias("v"), (F.col("l_discount") * 100).alias("w"))
    w = w.withColumn("stated", real(F.sum(F.col("v").cast("decimal(18,2)")).over(Window.partitionBy("book"))) * 1.0001)
    return books.rebase_from_value(w, "book", "v", "w", "stated").select("book", "n", F.round("w", 6).alias("w"))


@query("residual_absorb", """
WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, l_linestatus = 'O' AS cash, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
s AS (SELECT *, CAST(v AS DOUBLE) * 99.7 / CAST(sum(v) OVER p AS DOUBLE) AS w, max(n) FILTER (WHERE cash) OVER p AS last FROM w WINDOW p AS (PARTITION BY book)),
t AS (SELECT *, CAST(sum(CAST(w AS DECIMAL(38,10))) OVER (PARTITION BY book) AS DOUBLE) AS total FROM s)
SELECT book, n, CAST(round(CAST(CASE WHEN cash AND n = last AND total >= 99.5 AND total < 99.95 THEN w + 100 - total ELSE w END AS DECIMAL(20,8)), 4) AS DOUBLE) AS w FROM t""")
def residual_absorb(t):
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), (F.col("l_linestatus") == "O").alias("cash"), money("l_extendedprice").alias("v"))
    w = w.withColumn("w", real(F.col("v")) * 99.7 / real(F.sum("v").over(Window.partitionBy("book"))))
    return books.absorb_residual(w, "book", "n", "w", F.col("cash")).select("book", "n", real(F.round(F.col("w").cast("decimal(20,8)"), 4)).alias("w"))


@query("rollup_row_drop", """
WITH w AS (SELECT l_orderkey AS book, l_linenumber AS n, l_quantity AS w, CASE WHEN l_linenumber > 1 THEN CASE WHEN l_returnflag = 'N' THEN 'receivables' ELSE 'cash' END END AS kind FROM lineitem),
s AS (SELECT *, CAST(sum(CAST(w AS DECIMAL(38,10))) FILTER (WHERE kind IS NOT NULL) OVER p AS DOUBLE) AS s, count(*) FILTER (WHERE kind = 'cash') OVER p AS nc, count(*) FILTER (WHERE kind = 'receivables') OVER p AS nr FROM w WINDOW p AS (PARTITION BY book))
SELECT book, n FROM s WHERE NOT coalesce(n = 1 AND nc > 0 AND nr > 0 AND abs(w - s) <= 40, false)""")
def rollup_row_drop(t):
    w = t.lineitem.select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("w"), F.when(F.col("l_returnflag") == "N", "receivables").otherwise("cash").alias("kind"))
    return books.drop_rollup(w, "book", "w", F.col("n") == 1, F.col("kind"), "receivables", 40.0).select("book", "n")


@query("collapse_adjacent", """
WITH e AS (SELECT user_id, event_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS nx FROM events)
SELECT user_id, event_id, event_type FROM e WHERE NOT coalesce(event_type = 'click' AND nx = 'click', false)""")
def collapse_adjacent(t):
    return books.collapse_adjacent(t.events, "user_id", "event_id", F.col("event_type") == "click").select("user_id", "event_id", "event_type")


@query("full_outer_compare", """
WITH a AS (SELECT l_suppkey, l_partkey, avg(l_discount * 100) AS w FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), b AS (SELECT l_suppkey, l_partkey, avg(l_tax * 100) AS w FROM lineitem WHERE l_linenumber >= 3 GROUP BY ALL),
j AS (SELECT coalesce(a.l_suppkey, b.l_suppkey) AS k, round(a.w, 6) AS x, round(b.w, 6) AS y FROM a FULL JOIN b USING (l_suppkey, l_partkey)),
s AS (SELECT k, CASE WHEN y IS NULL THEN 'ours_only' WHEN x IS NULL THEN 'theirs_only' WHEN abs(x - y) <= 0.35 OR abs(x - y) / greatest(abs(x), 0.2) <= 0.15 THEN 'match' ELSE 'off' END AS status FROM j)
SELECT status, count(*) AS n FROM s GROUP BY status""")
def full_outer_compare(t):
    keys = ["l_suppkey", "l_partkey"]
    a = t.lineitem.where("l_linenumber <= 3").groupBy(*keys).agg(F.round(F.avg(F.col("l_discount") * 100), 6).alias("w"))
    b = t.lineitem.where("l_linenumber >= 3").groupBy(*keys).agg(F.round(F.avg(F.col("l_tax") * 100), 6).alias("w"))
    return compare.full_compare(a, b, keys, "w").groupBy("status").agg(F.count("*").alias("n"))


@query("root_cause_classes", """
WITH a AS (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v, count(*) AS n FROM lineitem WHERE l_suppkey % 7 > 0 GROUP BY 1),
b AS (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) * CASE WHEN l_suppkey % 5 = 0 THEN 100 ELSE 1 END AS v, count(*) AS n FROM lineitem WHERE l_suppkey % 3 > 0 AND (l_suppkey % 4 > 0 OR l_returnflag = 'R') GROUP BY 1)
SELECT s.s_suppkey AS k, CASE WHEN a.v IS NULL AND b.v IS NULL THEN 'both_missing' WHEN b.v IS NULL THEN 'vendor_missing' WHEN a.v IS NULL THEN 'parser_missing' WHEN abs(a.v - b.v) <= 0.05 THEN 'match'
  WHEN a.v > 0 AND abs(b.v / a.v - 100) <= 1 THEN 'vendor_percent_scale' WHEN b.v > 0 AND abs(a.v / b.v - 100) <= 1 THEN 'parser_percent_scale' WHEN abs(a.v - b.v) > 0.05 * abs(a.v) THEN 'total_differs' WHEN a.n <> b.n THEN 'row_count_differs'
  WHEN abs(a.v - b.v) <= 0.35 OR abs(a.v - b.v) / greatest(abs(a.v), 0.2) <= 0.15 THEN 'rounding' ELSE 'weight_differs' END AS reason
FROM supplier s LEFT JOIN a ON a.k = s.s_suppkey LEFT JOIN b ON b.k = s.s_suppkey""")
def root_cause_classes(t):
    li = t.lineitem
    total = lambda d: d.groupBy(F.col("l_suppkey").alias("k")).agg(real(F.sum(money("l_extendedprice"))).alias("v"), F.count("*").alias("n"))
    a = total(li.where("l_suppkey % 7 > 0"))
    b = total(li.where("l_suppkey % 3 > 0 and (l_suppkey % 4 > 0 or l_returnflag = 'R')")).withColumn("v", F.col("v") * F.when(F.col("k") % 5 == 0, 100).otherwise(1))
    j = t.supplier.select(F.col("s_suppkey").alias("k")).join(a, "k", "left").join(b.select("k", F.col("v").alias("y"), F.col("n").alias("m")), "k", "left")
    return j.select("k", compare.root_cause(F.col("v"), F.col("y"), F.col("v"), F.col("y"), F.col("n") == F.col("m")).alias("reason"))


@query("rollup_subset_sum", """
WITH f AS (SELECT l_suppkey AS k, l_quantity AS q, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS r FROM lineitem QUALIFY r <= 25),
two AS (SELECT DISTINCT a.k FROM f a JOIN f b ON a.k = b.k AND a.r < b.r WHERE abs(a.q + b.q - 97) <= 0.15),
three AS (SELECT DISTINCT a.k FROM f a JOIN f b ON a.k = b.k AND a.r < b.r JOIN f c ON c.k = b.k AND b.r < c.r WHERE abs(a.q + b.q + c.q - 97) <= 0.15)
SELECT DISTINCT k AS l_suppkey, k IN (SELECT k FROM two) OR k IN (SELECT k FROM three) AS can FROM f""")
def rollup_subset_sum(t):
    """Whether two or three of a supplier's largest weights sum to 97."""
    w = Window.partitionBy("l_suppkey").orderBy(F.col("l_quantity").desc(), "l_orderkey", "l_linenumber")
    few = t.lineitem.withColumn("r", F.row_number().over(w)).where("r <= 25").groupBy("l_suppkey").agg(F.collect_list("l_quantity").alias("ws"))
    return few.select("l_suppkey", compare.can_roll_up(F.lit(97.0), F.col("ws")).alias("can"))


@query("union_rank_dedup", """
WITH u AS (SELECT o_custkey, o_orderkey, 0 AS r FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, 1 FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o_custkey, o_orderkey, r AS src_rank FROM u QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY r, o_orderkey) = 1""")
def union_rank_dedup(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    keep = ["o_custkey", "o_orderkey"]
    return picks.by_precedence([o.where("o_orderstatus = 'F'").select(*keep), o.where("o_orderpriority = '1-URGENT'").select(*keep)], ["o_custkey"], F.col("o_orderkey"))


@query("filings_merge", """
WITH f AS (SELECT CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS as_of, count(*) AS a, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS b FROM orders GROUP BY 1)
SELECT as_of, 'monthly' AS cadence, CASE WHEN as_of >= '1996' AND b > 0 THEN b ELSE a END AS portfolio_count FROM f""")
def filings_merge(t):
    o = t.orders.select(F.last_day(F.to_date("o_orderdate")).alias("as_of"), "o_orderkey")
    count = lambda d: d.groupBy("as_of").agg(F.count("*").alias("portfolio_count")).withColumn("cadence", F.lit("monthly"))
    out = catalog.merge_filings(count(o), count(o.where((F.col("o_orderkey") % 2 == 0) & (F.year("as_of") >= 1996))))
    return out.select(text("as_of").alias("as_of"), "cadence", "portfolio_count")


@query("published_contract", """
SELECT l_suppkey AS book, p_name AS instrument, 'INE' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS isin, 'equity' AS holding_type, p_brand AS industry, CAST(NULL AS VARCHAR) AS rating, CAST(NULL AS DOUBLE) AS coupon, l_quantity AS quantity, l_extendedprice AS market_value,
  round_even(l_extendedprice * 100 / CAST(sum(CAST(l_extendedprice AS DECIMAL(38,10))) OVER (PARTITION BY l_suppkey) AS DOUBLE), 6) AS pct_nav, CAST(NULL AS DOUBLE) AS ytm, CAST(NULL AS DOUBLE) AS ytc, CAST(NULL AS DOUBLE) AS instrument_yield, CAST(NULL AS VARCHAR) AS maturity_date, p_type AS section, CAST(NULL AS VARCHAR) AS listed_status, CAST(NULL AS VARCHAR) AS underlying, CAST(NULL AS VARCHAR) AS position_side
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def published_contract(t):
    """Raw holdings shaped to the 17 contract fields."""
    raw = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("book"), F.col("p_name").alias("instrument"), F.concat(F.lit("INE"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("isin"), F.col("p_type").alias("section"), F.col("p_brand").alias("industry"),
        F.lit(None).cast("string").alias("industry_rating"), F.lit(None).cast("string").alias("rating"), F.lit("").alias("coupon"), text("l_quantity").alias("quantity"), text("l_extendedprice").alias("market_value"), F.lit("nil").alias("pct_nav"), F.lit("-").alias("ytm"), F.lit("").alias("ytc"), F.lit("").alias("instrument_yield"), F.lit("").alias("maturity_date"))
    return books.publish(raw)


@query("lock_mismatches", """
SELECT c_custkey AS k, c_nationkey AS expected, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey + CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END END AS actual, CASE WHEN c_custkey % 11 = 0 THEN 'missing' ELSE 'differs' END AS reason FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 13 = 0""")
def lock_mismatches(t):
    e = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"))
    a = e.where("k % 11 > 0").withColumn("v", F.col("v") + F.when(F.col("k") % 13 == 0, 1).otherwise(0))
    return guards.lock_mismatches(e, a, "k", "v")


@query("completeness_report", """
SELECT o_orderstatus AS status, count(*) AS expected, count(*) FILTER (WHERE k AND NOT s) AS covered, count(*) FILTER (WHERE NOT k) AS missing, count(*) FILTER (WHERE k AND s) AS stale
FROM (SELECT *, o_orderkey % 3 > 0 AS k, o_orderkey % 5 = 0 AS s FROM orders) GROUP BY 1""")
def completeness_report(t):
    files = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("modified"))
    done = files.where("k % 3 > 0").select("k", F.when(F.col("k") % 5 == 0, F.col("modified") - F.expr("interval 1 day")).otherwise(F.col("modified")).alias("modified"))
    return guards.completeness(files, done, ["status"], "k")
