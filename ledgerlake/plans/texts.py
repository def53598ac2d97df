"""Queries over documents, pages, events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, dates, numbers
from ..functions import text as T
from ..operators import sheets
from ..sources import pages as P
from ..streaming import events as S
from .registry import joined, query, real, text


@query("exact_dup_documents", """
WITH k AS (SELECT doc_id, trim(regexp_replace(lower(replace(text, '&', ' and ')), '[^a-z0-9]+', ' ', 'g')) AS k FROM documents)
SELECT min(doc_id) AS doc_id, count(*) AS n FROM k GROUP BY k HAVING count(*) > 1""")
def exact_dup_documents(t):
    """Groups of documents with equal text keys."""
    return t.documents.groupBy(F.sha2(T.norm_text(F.col("text")), 256).alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n > 1").select("doc_id", "n")


@query("section_fill", """
WITH m AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn END AS u FROM conversations)
SELECT conv_id, turn, last_value(u IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM m""")
def section_fill(t):
    """The section a row stands under: the last marker."""
    return sheets.carry_down(t.conversations, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("turn")), "section").select("conv_id", "turn", "section")


@query("block_split", "SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS block FROM conversations")
def block_split(t):
    return sheets.blocks(t.conversations, ["conv_id"], "turn", F.col("role") == "user", "block").select("conv_id", "turn", "block")


@query("annex_trim", """
WITH s AS (SELECT conv_id, turn, role, min(turn) FILTER (WHERE role = 'assistant') OVER (PARTITION BY conv_id) AS stop FROM conversations) SELECT conv_id, turn FROM s WHERE stop IS NULL OR turn < stop""")
def annex_trim(t):
    return sheets.trim_after(t.conversations, ["conv_id"], "turn", F.col("role") == "assistant").select("conv_id", "turn")


@query("header_pick", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS row_no FROM documents),
s AS (SELECT doc_id, row_no, length(line) - length(replace(line, ',', '')) AS sc FROM l)
SELECT doc_id, coalesce(min(row_no) FILTER (WHERE sc >= 10), (arg_max(row_no, sc * 100000 - row_no) FILTER (WHERE sc >= 2)))::BIGINT AS header_row FROM s GROUP BY doc_id""")
def header_pick(t):
    """The header's row: the first good score, else the first best."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_no", "line"))
    score = F.length("line") - F.length(F.replace(F.col("line"), F.lit(","), F.lit("")))
    return sheets.header_rows(lines, ["doc_id"], "row_no", score).select("doc_id", F.col("header_row").cast("long").alias("header_row"))


@query("holding_type_classifier", "SELECT p_partkey, ['equity', 'debt', 'cash', 'other', 'fund_unit', 'derivative', 'money_market', 'other'][1 + p_partkey % 8] AS holding_type FROM part")
def holding_type_classifier(t):
    """The contract's classifier over made-up holdings."""
    h = t.part.select("p_partkey", F.concat_ws(" ", "p_name", F.element_at(F.array(*[F.lit(x) for x in ("Ltd", "7.5% Bond", "TREPS", "Gold", "ETF", "Nifty Futures", "Treasury Bill", "units")]), (1 + F.col("p_partkey") % 8).cast("int"))).alias("name"), F.col("p_type").alias("section"))
    return h.select("p_partkey", classify.holding_type(F.col("name"), F.col("section"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("holding_type"))


@query("half_month_slice", """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem),
s AS (SELECT CASE WHEN day(d) BETWEEN 13 AND 16 THEN date_trunc('month', d)::DATE + 14 WHEN day(d) >= 27 OR day(d) >= day(last_day(d)) - 3 THEN last_day(d) END AS filing, CASE WHEN day(d) <= 16 THEN date_trunc('month', d)::DATE + 14 ELSE last_day(d) END AS target FROM d)
SELECT CAST(filing AS VARCHAR) AS filing, CAST(target AS VARCHAR) AS target, CASE WHEN day(target) = 15 THEN 'fortnightly' ELSE 'monthly' END AS cadence, count(*) AS n FROM s GROUP BY ALL""")
def half_month_slice(t):
    """Filing slice, requested slice and cadence of every day."""
    d = F.to_date("l_shipdate")
    s = t.lineitem.select(dates.filing_slice(d).alias("f"), dates.target_slice(d).alias("g"))
    return s.groupBy("f", "g").agg(F.count("*").alias("n")).select(text("f").alias("filing"), text("g").alias("target"), dates.cadence(F.col("g")).alias("cadence"), "n")


@query("period_expansion", """
WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS m FROM orders), c AS (SELECT m, unnest(['monthly', 'fortnightly']) AS cadence FROM m)
SELECT CAST(m AS VARCHAR) AS period, cadence, CASE WHEN cadence = 'monthly' THEN CAST(last_day(m) AS VARCHAR) ELSE CAST(m + 14 AS VARCHAR) || ',' || CAST(last_day(m) AS VARCHAR) END AS keys, CASE WHEN month(m) >= 4 THEN year(m) || '-' || lpad(((year(m) + 1) % 100)::VARCHAR, 2, '0') ELSE (year(m) - 1) || '-' || lpad((year(m) % 100)::VARCHAR, 2, '0') END AS fy FROM c""")
def period_expansion(t):
    """Months of orders to storage keys by cadence, with their financial year."""
    m = t.orders.select(F.trunc("o_orderdate", "MM").alias("m")).distinct().withColumn("cadence", F.explode(F.array(F.lit("monthly"), F.lit("fortnightly"))))
    return m.select(text("m").alias("period"), "cadence", joined(dates.period_keys(F.col("m"), F.col("cadence"))).alias("keys"), dates.financial_year(F.col("m")).alias("fy"))


@query("date_from_text", """
WITH d AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 YEAR AS DATE) AS d FROM orders)
SELECT o_orderkey, unnest(['Portfolio as on ' || strftime(d, '%d-%b-%Y'), 'As on ' || strftime(d, '%B %-d, %Y'), strftime(d, '%d/%m/%Y'), 'statement as on : ' || (d - DATE '1899-12-30')::VARCHAR, 'book_' || strftime(d, '%Y-%m-%d') || '.xlsx']) AS banner, CAST(d AS VARCHAR) AS as_of, true AS same FROM d""")
def date_from_text(t):
    """As-of dates of banners in several spellings, thirty years after the orders."""
    d = F.add_months(F.to_date("o_orderdate"), 360)
    styles = F.array(F.concat(F.lit("Portfolio as on "), F.date_format(d, "dd-MMM-yyyy")), F.concat(F.lit("As on "), F.date_format(d, "MMMM d, yyyy")), F.date_format(d, "dd/MM/yyyy"), F.concat(F.lit("statement as on : "), (F.datediff(d, F.lit("1899-12-30").cast("date"))).cast("string")), F.date_format(d, "'book_'yyyy-MM-dd'.xlsx'"))
    x = t.orders.select("o_orderkey", d.alias("d"), F.explode(styles).alias("banner"))
    return x.select("o_orderkey", "banner", text(dates.parse_as_of(F.col("banner"))).alias("as_of"), (dates.parse_as_of(F.col("banner")) == F.col("d")).alias("same"))


@query("number_coercion", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'nil' WHEN 1 THEN '1,' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') || '.50' WHEN 2 THEN (p_partkey % 100)::VARCHAR || '%' WHEN 3 THEN 'Rs. ' || p_partkey::VARCHAR WHEN 4 THEN 'about ' || p_partkey::VARCHAR || ' units' WHEN 5 THEN '-' ELSE '1d' END AS s FROM part)
SELECT p_partkey, CASE p_partkey % 7 WHEN 1 THEN 1000 + p_partkey % 1000 + 0.5 WHEN 2 THEN p_partkey % 100 WHEN 3 THEN p_partkey WHEN 4 THEN p_partkey WHEN 6 THEN 1 END::DOUBLE AS api, CASE p_partkey % 7 WHEN 1 THEN 1000 + p_partkey % 1000 + 0.5 WHEN 2 THEN p_partkey % 100 END::DOUBLE AS parser FROM s""")
def number_coercion(t):
    k = F.col("p_partkey")
    s = text(k)
    raw = F.element_at(F.array(F.lit("nil"), F.concat(F.lit("1,"), F.lpad(text(k % 1000), 3, "0"), F.lit(".50")), F.concat(text(k % 100), F.lit("%")), F.concat(F.lit("Rs. "), s), F.concat(F.lit("about "), s, F.lit(" units")), F.lit("-"), F.lit("1d")), (k % 7 + 1).cast("int"))
    return t.part.select("p_partkey", raw.alias("s")).select("p_partkey", numbers.parse_number(F.col("s")).alias("api"), numbers.parser_number(F.col("s")).alias("parser"))


@query("text_keys", """
SELECT p_partkey, trim(regexp_replace(lower(replace(p_name, '&', ' and ')), '[^a-z0-9]+', ' ', 'g')) AS norm, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS compact, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS shortcode, substring(regexp_replace(trim(p_type), '[^A-Za-z0-9._-]+', '_', 'g'), 1, 180) AS safe FROM part""")
def text_keys(t):
    return t.part.select("p_partkey", T.norm_text(F.col("p_name")).alias("norm"), T.compact(F.col("p_name")).alias("compact"), T.shortcode(F.col("p_brand")).alias("shortcode"), T.safe_name(F.col("p_type")).alias("safe"))


@query("html_links", r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']+)["''][^>]*>', 1) AS hs FROM pages)
SELECT page_id, (unnest(range(1, len(hs) + 1)) - 1)::BIGINT AS pos, unnest(hs) AS href FROM l""")
def html_links(t):
    return P.links(t.pages).select("page_id", F.col("pos").cast("long").alias("pos"), "href")


@query("html_absolute_links", r"""
WITH l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') AS origin, regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']+)["''][^>]*>', 1) AS hs FROM pages),
h AS (SELECT page_id, origin, unnest(range(0, len(hs))) AS pos, unnest(hs) AS href FROM l)
SELECT page_id, pos::BIGINT AS pos, CASE WHEN href LIKE '/%' THEN replace(origin || href, ' ', '%20') ELSE replace(href, ' ', '%20') END AS link FROM h""")
def html_absolute_links(t):
    return P.links(t.pages).select("page_id", F.col("pos").cast("long").alias("pos"), P.absolute(F.col("url"), F.col("href")).alias("link"))


@query("html_year_walk")
def html_year_walk(t):
    return P.links_with_year(t.pages)


@query("json_props", """
SELECT event_id, event_type, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, len(json_keys(props))::BIGINT AS n_keys FROM events WHERE props IS NOT NULL""")
def json_props(t):
    """The first property of each event's JSON."""
    e = t.events.where("props is not null").withColumn("keys", F.json_object_keys("props"))
    m = F.from_json("props", "map<string,string>")
    return e.select("event_id", "event_type", F.try_element_at(m, F.try_element_at("keys", F.lit(1))).alias("first_value"), F.size("keys").cast("long").alias("n_keys"))


@query("map_annotate", "SELECT event_id, len(list_filter(json_keys(props), lambda k: length(coalesce(json_extract_string(props, '$.' || k), '')) > 0))::BIGINT + 1 AS n, '1' AS flag FROM events WHERE props IS NOT NULL")
def map_annotate(t):
    m = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("rescaled"), F.lit("1")))
    kept = F.map_filter(m, lambda k, v: F.length(v) > 0)
    return t.events.where("props is not null").select("event_id", F.size(kept).cast("long").alias("n"), kept["rescaled"].alias("flag"))


@query("histogram_top20", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(DISTINCT user_id) AS users, bool_or(event_type = 'purchase') AS bought FROM events GROUP BY 1 ORDER BY n DESC, day LIMIT 20")
def histogram_top20(t):
    g = t.events.groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.bool_or(F.col("event_type") == "purchase").alias("bought"))
    return g.orderBy(F.col("n").desc(), "d").limit(20).select(text("d").alias("day"), "n", "users", "bought")


@query("approx_distinct")
def approx_distinct(t):
    return t.events.groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"), F.percentile_approx("value", 0.5).alias("median_value"))


@query("tumbling_windows", "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(t):
    return S.tumbling(t.events, "1 hour").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", real(F.col("total")).alias("total"))


@query("sliding_windows", """
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS h FROM events) GROUP BY 1""")
def sliding_windows(t):
    return S.sliding(t.events, "2 hours", "1 hour").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("session_windows", """
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS stop, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(t):
    """A user's events with gaps of less than half an hour."""
    show = lambda c, n: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n)
    return S.sessions(t.events, "30 minutes").select("user_id", show("start", "start"), show("end", "stop"), "n")


@query("half_month_events", """
SELECT CAST(CASE WHEN day(ts) <= 16 THEN date_trunc('month', ts)::DATE + 14 ELSE last_day(CAST(ts AS DATE)) END AS VARCHAR) AS slice, count(*) AS n FROM events GROUP BY 1""")
def half_month_events(t):
    return S.half_months(t.events).select(text("slice").alias("slice"), "n")


@query("stream_dedup_watermark", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def stream_dedup_watermark(t):
    """The events as a file stream, each file twice, duplicates dropped within the watermark, run to its end."""
    import tempfile
    import uuid

    spark = t.spark
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = "file://" + tempfile.mkdtemp(prefix="stream")
    base = f"{base}/events-{uuid.uuid4().hex}"
    t.events.unionByName(t.events).repartition(4).write.parquet(f"{base}/in")
    stream = S.deduplicated(S.source(spark, f"{base}/in", t.events.schema), ["event_id"], late="45 days")
    S.run_available(stream.select("event_id", "event_type"), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"))


@query("udtf_lines", """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
SELECT doc_id, (unnest(range(1, len(ls) + 1)) - 1)::BIGINT AS row_no, length(unnest(ls))::BIGINT AS n FROM l""")
def udtf_lines(t):
    """A user's table function: lines of a text with their numbers."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="row_no int, line string")
    class Lines:
        def eval(self, text: str):
            yield from enumerate((text or "").split("\n"))

    t.spark.udtf.register("ledger_lines", Lines)
    t.documents.createOrReplaceTempView("ledger_documents")
    return t.spark.sql("SELECT d.doc_id, CAST(l.row_no AS BIGINT) AS row_no, CAST(length(l.line) AS BIGINT) AS n FROM ledger_documents d, LATERAL ledger_lines(d.text) l")


@query("file_classification", """
WITH f AS (SELECT o_orderkey AS k, o_orderkey % 6 AS c FROM orders)
SELECT k, CASE c WHEN 0 THEN 'not_spreadsheet' WHEN 1 THEN 'excluded_non_portfolio' WHEN 2 THEN 'wrong_month' WHEN 3 THEN 'as_of_slice' WHEN 4 THEN 'month_in_name' ELSE 'undated_no_month' END AS reason, c IN (3, 4) AS keep FROM f""")
def file_classification(t):
    names = F.array(*[F.lit(x) for x in ("Portfolio Aug 2026.pdf", "Half Yearly Portfolio Aug 2026.xlsx", "Portfolio Jul 2026.xlsx", "Portfolio 31-Aug-2026.xlsx", "Portfolio Aug 2026.xlsx", "Portfolio.xlsx")])
    f = t.orders.select(F.col("o_orderkey").alias("k"), F.element_at(names, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("name"))
    name, day = F.col("name"), lambda s: F.lit(s).cast("date")
    reason = classify.file_reason(F.lit(None).cast("string"), name, dates.extract_dates(name), dates.all_months(name), dates.matches_as_of(name, day("2026-08-31")), day("2026-08-01"), day("2026-08-31"), F.lit(False))
    return f.select("k", reason.alias("reason")).withColumn("keep", F.col("reason").isin(*classify.KEEP_REASONS))
