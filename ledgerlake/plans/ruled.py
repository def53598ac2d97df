"""Rules over texts made of the tables' columns, with SQL that works each rule out by its own means.

Inputs are written once, in SQL that both engines read; patterns are the library's fixed values, the steps are not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import classify, dates, landed, names, numbers
from ..functions import similarity as S
from ..functions import text as T
from ..operators import matching, sheets
from ..sources import schememaster
from .market import _SCORED
from .registry import query


def pick(*forms: str, key: str = "p_partkey") -> str:
    """One of some SQL expressions, by a key."""
    return f"CASE {key} % {len(forms)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END"


def ruled(name: str, doc: str, inputs: dict[str, str], rules: dict[str, Callable[..., Column]], sql: dict[str, str], table: str = "part", key: str = "p_partkey", where: str = "true") -> None:
    """Register ``rules`` (column: function of the inputs) over inputs of a table's rows; ``sql`` has the same columns."""

    def run(t):
        rows = getattr(t, table).where(where).select(key, *[F.expr(x).alias(n) for n, x in inputs.items()])
        return rows.select(key, *[rule(*[F.col(n) for n in inputs]).alias(out) for out, rule in rules.items()])

    run.__doc__ = doc
    given = ", ".join(f"{x} AS {n}" for n, x in inputs.items())
    out = ", ".join(f"{x} AS {n}" for n, x in sql.items())
    query(name, f"WITH x AS (SELECT {key}, {given} FROM {table} WHERE {where}) SELECT {key}, {out} FROM x")(run)


def has(x: str, pattern: str) -> str:
    """DuckDB's search. Its patterns don't look around: what stands before is matched instead."""
    for a, b in (("(?<=[A-Za-z.])", "[A-Za-z.]"), ("(?<![A-Za-z0-9])", "(?:^|[^A-Za-z0-9])"), (r"(?<!\^)", r"(?:^|[^\^])"), ("(?<![A-Za-z])", "(?:^|[^A-Za-z])"), ("(?![A-Za-z])", "(?:$|[^A-Za-z])")):
        pattern = pattern.replace(a, b)
    return f"coalesce(regexp_matches({x}, '{pattern}', 'i'), false)"


def cut(x: str, patterns, to: str = "", flags: str = "gi") -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '{to}', '{flags}')"
    return x


_SQUEEZE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_NORM = "trim(regexp_replace(replace(lower(coalesce({0}, '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_VARIANT = "|".join(w.replace(" ", r"\s+") for w in names.VARIANT_WORDS)

# ---------------------------------------------------------------- classifiers

_PAPERS = pick("p_name || ' Ltd'", "'TREPS ' || p_name", "'Reverse Repo ' || p_size", "p_size || '.5% ' || p_name || ' NCD'", "'Interest Rate Swap ' || p_name", "'Net Current Assets'", "p_name || ' Margin Money'", "'Commercial Paper ' || p_name", "'Clearing Corporation of India'", "p_name || ' OIS 2y'", "NULL")
_SECTIONS = pick("'Equity'", "'Cash and Other Net Current Assets'", "'TREPS / Reverse repo'", "NULL", key="p_size")
_CODES = pick("''", "'INE' || lpad('' || p_partkey, 9, '0')", "NULL", key="(p_partkey + p_size)")
ruled(
    "cash_names", "Whether papers named after parts are cash, by name, section and code.", {"n": _PAPERS, "s": _SECTIONS, "i": _CODES}, {"cash": classify.is_cash},
    {"cash": f"NOT {has('n', r'interest\s+rate\s+swaps?|\birs\b|(?<![A-Za-z])ois(?![A-Za-z])')} AND ({has('n', classify.CASH)} OR (NOT {has('n', classify.NOT_CASH)} AND {has('s', classify.CASH)} AND trim(coalesce(i, '')) = '' AND NOT ({has('n', r'\d+(?:\.\d+)?\s*%')} AND NOT {has('n', 'repo')})))"},
)
_CONTRACTS = pick("p_name || ' Ltd 28-Jul-2026'", "p_name || ' Ltd.28/07/2026'", "p_name || ' JUL-2026'", "p_name || ' Covered Call$$'", "'Interest Rate Swap ' || p_name", "p_name || ' 25000 CALL'", "p_name || ' Ltd'", "'GOI ' || p_name || ' 18-Aug-2055'", "p_name || ' $$'", "'**' || p_name || ' NCD $$'", "p_name || '^'", "p_name || '^^'", "'Net Current Assets^'", "p_name || ' 25/08/2026'", "'MAT - 24/07/2037'", "'GOLD-05AUG2026-MCX ' || p_size", "p_name || ' - August 2026 - Future'")
_BOOKS = pick("NULL", "'Stock Futures'", "'Index Options'", "'Equity'", "'f) Derivative'", key="p_size")
_named = has("n", "|".join(classify.FUTURE_NAMES))
ruled(
    "future_names", "Whether contracts named after parts are futures under a house's policy.",
    {"n": _CONTRACTS, "s": _BOOKS, "ind": pick("NULL", "'Banks'", "'Stock Futures'", key="(p_partkey * 7 + p_size)"), "i": _CODES, "neg": "p_partkey % 2 = 0", "swaps": "p_size % 2 = 0", "options": "p_size % 3 > 0"}, {"future": classify.is_future},
    {"future": f"""CASE WHEN {has('n', classify.COVERED_CALL)} THEN false WHEN {has('n', classify.SWAP_NAME)} THEN swaps WHEN {has('s', classify.OPTION_WORD)} OR {has('ind', classify.OPTION_WORD)} OR {has('n', classify.PUT_OR_CALL)} THEN options
  WHEN ({has('s', classify.FUTURE_SECTION)} OR {has('s', classify.FUTURE_HEAD)} OR {has('ind', classify.FUTURE_INDUSTRY)}) AND (trim(coalesce(i, '')) = '' OR {_named} OR neg) THEN true
  WHEN {_named} AND NOT {has('n', classify.DATED_PAPER)} AND NOT {has('n', classify.COUPON_NAME)} THEN true
  WHEN {has('n', classify.DAY_ALONE)} AND trim(coalesce(i, '')) = '' AND NOT contains(n, '%') AND NOT {has('n', classify.MATURING_PAPER)} THEN true
  WHEN {has('n', classify.DOLLARS)} THEN NOT {has('n', classify.DOLLAR_DEBT)} WHEN {has('n', classify.CARET)} THEN NOT {has('n', classify.CARET_CASH)} ELSE false END"""},
)
_RATINGS = pick("'CRISIL ' || CASE p_size % 3 WHEN 0 THEN 'AAA' WHEN 1 THEN 'AA+' ELSE 'A1+' END", "p_name", "'Sovereign'", "'[ICRA]AAA'", "' aa- / Stable'", "'icra/bbb'", "NULL", "'AAAA'", "'unrated'")
_rating = lambda x: f"coalesce(regexp_matches(trim({x}), '{classify.RATING}', 'i'), false)"
ruled(
    "rating_cells", "Whether cells are ratings, and what a mixed column's cell tells besides an industry and a rating.",
    {"m": _RATINGS, "ind": pick("NULL", "p_name", "'Banks'", key="p_size"), "r": pick("NULL", "'AA+'", "'A1+'", key="(p_partkey + 2 * p_size)")},
    {"rated": lambda m, ind, r: classify.looks_rating(m), "industry": lambda m, ind, r: classify.industry_and_rating(ind, m, r)["industry"], "rating": lambda m, ind, r: classify.industry_and_rating(ind, m, r)["rating"]},
    {"rated": _rating("m"), "industry": f"coalesce(ind, CASE WHEN NOT {_rating('m')} THEN m END)", "rating": f"CASE WHEN r IS NOT NULL AND ind IS NOT NULL THEN CASE WHEN {_rating('m')} AND lower(m) <> lower(ind) THEN m ELSE r END WHEN r IS NOT NULL THEN r WHEN {_rating('m')} AND (ind IS NULL OR lower(m) <> lower(ind)) THEN m END"},
)
ruled(
    "plan_flags_of_parts", "What plans' names say of direct, growth and payout: yes, no, or nothing.",
    {"n": pick("p_name || ' Fund - Direct Plan - Growth'", "p_name || ' Regular IDCW'", "p_name || ' Retail Dividend Payout'", "p_name || ' Direct Growth Reinvestment'", "p_name")},
    {k: (lambda n, k=k: schememaster.plan_flags(n)[k]) for k in ("direct", "growth", "idcw")},
    {"direct": f"CASE WHEN {has('n', r'\bdirect\b')} THEN true WHEN {has('n', r'\bregular\b|\bretail\b')} THEN false END", "growth": f"CASE WHEN {has('n', r'\bidcw\b|\bdividend\b|payout|reinvest|income distribution')} THEN false WHEN {has('n', r'\bgrowth\b')} THEN true END", "idcw": f"CASE WHEN {has('n', r'\bidcw\b|\bdividend\b|payout|reinvest|income distribution')} THEN true WHEN {has('n', r'\bgrowth\b')} THEN false END"},
)

# ---------------------------------------------------------------- names

_FUNDS = pick("p_name || ' Liquid Fund'", "p_name || ' FMP Series ' || p_size", "upper(substr(p_name, 1, 4)) || p_size", "p_name || ' Fund Unclaimed'", "p_name || ' Nifty ETF'", "'' || p_size", "'Disclaimer'", "p_name || ' Institutional Plan'", "'TOTAL'", "p_name || ' Banking & PSU Debt Scheme'")
ruled(
    "name_shapes", "Shapes of names: debt-like, closed-end, a variant's, a short code's, a fund's.", {"n": _FUNDS},
    {"debt": names.is_debt_like, "closed_end": names.is_closed_end, "variant": names.is_secondary, "code": names.is_shortcode, "fund": names.looks_like_fund},
    {"debt": has("n", names.DEBT_WORDS), "closed_end": has("n", names.CLOSED_END), "variant": has("n", rf"\b(?:{_VARIANT})"), "code": "regexp_matches(n, '^[A-Z0-9]{2,10}$') AND regexp_matches(n, '[A-Z]') AND n NOT IN ('NAV', 'ISIN', 'TOTAL', 'INDEX')", "fund": f"length(n) >= 8 AND {has('n', r'\b(?:fund|etf|fof|scheme|plan|index)\b')} AND NOT {has('n', names.JUNK)}"},
)
_SPELT = pick("'Owsal ' || p_name || ' Glit Fund'", "'Large & Midcap ' || p_name || ' Fund'", "p_name || ' ETF Fund of Funds'", "p_name || ' MMF'", "p_name || ' Low Duratio'", "p_name || ' Interval Fund Interval Fund'", "p_name || ' midsmallcap Hybrd'", "NULL")


def _root(x: str) -> str:
    t = _NORM.format(x)
    for a, b in names.NAME_REWRITES:
        t = f"replace({t}, '{a}', '{b}')"
    t = f"replace(regexp_replace({_SQUEEZE.format(cut(t, [r'\bmmf\b'], 'money market fund'))}, 'duratio$', 'duration'), ' ', '')"
    for a, b in (("duratio", "duration"), ("durationn", "duration"), ("midsmallcapcap", "midsmallcap"), ("intervalfundintervalfund", "intervalfund")):
        t = f"replace({t}, '{a}', '{b}')"
    return t


def _expanded(x: str) -> str:
    t = _SQUEEZE.format(x)
    for p, to in names.ABBREVIATIONS:
        t = cut(t, [p], to)
    return _SQUEEZE.format(t)


ruled("root_keys_of_parts", "Keys in which misspelt and renamed names meet.", {"n": _SPELT}, {"key": names.root_key}, {"key": _root("n")})
ruled("expanded_labels", "Short labels in full.", {"n": pick("'Edel NY ' || p_size || ' IDX'", "p_name || ' LMcap 250'", "'G-S ' || p_name", "p_name || ' WD HC (I)'", "p_name || ' Series - 2'", "p_name || ' Fund of Funds - Aggressive'", "p_name || '  Pl ID  Fund'")}, {"label": names.expand}, {"label": _expanded("n")})
_tail = rf"\s*[-–(:]?\s*\b(?:{_VARIANT})s?\b.*$"
_DATE_END = r"[\s_\-]*(?:as\s+(?:on|of)\b.*|\d{1,2}[\s_\-]*[a-z]{3,9}[\s_\-]*\d{2,4}|[a-z]{3,9}[\s_\-]*20\d{2})\s*$"
_variant_sql, _base_sql = "n", "n"
for _ in range(4):
    _variant_sql = f"trim({cut(_variant_sql, [_tail], '', 'i')})"
for _ in range(6):
    _base_sql = f"trim({cut(_base_sql, [T.PLAN_TAIL.removeprefix('(?i)')], '', 'i')})"
_dated_sql = f"trim({cut('n', [_DATE_END], '', 'i')})"
ruled(
    "name_parts", "Labels without variants' tails, without plans, peeled, and the host that they are invested in.",
    {"n": pick("p_name || ' Fund - Unclaimed Redemption'", "p_name || ' Fund - Direct Plan - Growth'", "p_name || ' Fund as on 31 Aug 2026'", "'ABC ' || p_name || ' Aug 2026'", "p_name || ' Fund (Invested in ' || p_type || ' Overnight Fund)'", "p_name || ' Retail Cumulative Plan (IDCW)'")},
    {"variant": names.strip_variant, "base": T.base_name, "peeled": lambda n: F.array_join(names.peel(n), "|"), "host": T.invested_in},
    {"variant": _variant_sql, "base": _SQUEEZE.format(_base_sql), "peeled": f"array_to_string(list_filter([trim(n), {_dated_sql}, regexp_replace({_dated_sql}, '^\\S+\\s+', '')], lambda v, i: length(v) > 0 AND (i = 1 OR (i = 2 AND v <> trim(n)) OR (i = 3 AND v <> trim(n) AND v <> {_dated_sql}))), '|')", "host": r"nullif(trim(regexp_extract(n, '(?i)\binvested\s+in\s+(.+?)\s*\)?$', 1)), '')"},
)
_FILES = pick("upper(substr(p_name, 1, 3)) || '_portfolio_Aug_2026'", "'Portfolio (' || upper(substr(p_name, 1, 3)) || ') Aug'", "'portfolio-SB' || p_size", "replace(p_name, ' ', 'Flexi') || 'CapFund_Monthly_31'")
ruled(
    "file_name_parts", "Short codes and fund names of files' names.", {"n": _FILES}, {"code": names.pack_code, "fund": names.fund_from_file},
    {"code": r"coalesce(nullif(regexp_extract(n, '^([A-Z0-9]{2,8})[_\-]', 1), ''), nullif(regexp_extract(n, '\(([A-Z0-9]{2,8})\)', 1), ''), nullif(regexp_extract(n, '[_\-]([A-Z]{2,8}\d{0,3})$', 1), ''))", "fund": _SQUEEZE.format(r"regexp_replace(regexp_replace(regexp_replace(n, '[_\-+]|%20', ' ', 'g'), '([a-z])([A-Z])', '\1 \2', 'g'), '\b(?:\d{1,2}|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*|20\d{2}|monthly|fortnightly|portfolio|disclosure|final)\b', ' ', 'gi')")},
)
_compact = lambda x: f"replace({_NORM.format(x)}, ' ', '')"
ruled(
    "containment_of_parts", "Scores of names of which one holds the other.",
    {"a": pick("p_name || ' fund'", "p_name", "p_name || ' ' || p_brand || ' growth plan'", "p_type", key="p_size"), "b": "p_name || ' Fund' || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_type ELSE ' Series ' || p_size END"},
    {"score": lambda a, b: matching.containment_score(T.compact(a), T.compact(b))},
    {"score": f"(CASE WHEN {_compact('a')} = {_compact('b')} THEN 100.0 WHEN contains({_compact('b')}, {_compact('a')}) THEN greatest(90.0, 99 - least(abs(length({_compact('b')}) - length({_compact('a')})), 20) * 0.3) WHEN length({_compact('b')}) >= 10 AND contains({_compact('a')}, {_compact('b')}) THEN greatest(90.0, 99 - least(abs(length({_compact('b')}) - length({_compact('a')})), 40) * 0.2) ELSE 0.0 END)::DOUBLE"},
)

# ---------------------------------------------------------------- texts, headers, numbers

_MARKUP = pick("'<b>' || p_name || '</b> &amp; <i>' || p_type || '</i>'", "p_name || '&nbsp; &lt;' || p_size || '&gt;'", "' ' || p_name || '   x '", "'& \"' || p_name || '\" <' || p_size || '>'", "'nil'", "' - '", "''", "NULL")
ruled(
    "cleaned_texts", "Markup out, references decoded, marks escaped, empty tokens as nulls, codes and file names.", {"n": _MARKUP},
    {"plain": T.strip_tags, "shown": T.escaped, "kept": T.text_or_null, "code": T.shortcode, "file": T.safe_name},
    {"plain": _SQUEEZE.format("replace(replace(replace(replace(replace(replace(regexp_replace(n, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"), "shown": "replace(replace(replace(replace(replace(coalesce(n, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')", "kept": "CASE WHEN lower(trim(n)) NOT IN (" + ", ".join(f"'{x}'" for x in T.EMPTY_TOKENS) + ") THEN trim(n) END", "code": "upper(regexp_replace(n, '[^A-Za-z0-9]', '', 'g'))", "file": "substr(regexp_replace(trim(n), '[^A-Za-z0-9._-]+', '_', 'g'), 1, 180)"},
)
_HEADS = pick("'Name of the Instrument'", "'ISIN ' || p_size", "p_name || ' Coupon'", "'Yield to Call ' || p_name", "p_name || ' Maturity'", "'Yield to maturity'", "'Face Value'", "p_type || ' / Rating'", "'Quantity ' || p_size", "'Market Value (Rs. in Lakhs)'", "'% to NAV'", "'Sector ' || p_name", "p_name", "'Industry / Rating'", "'Put / Call'", "'Margin'", "'Duration ' || p_size")
_alias = " ".join(f"WHEN {has('h', p) if '(?<!to )' not in p else has(chr(39).join(['replace(lower(h), ', 'to maturity', ', ', 'to', ')']), p.replace('(?<!to )', ''))} THEN '{k}'" for k, p in sheets.HEADER_ALIASES.items())
ruled("header_aliases", "Canonical names of header cells made of known words and parts' names.", {"h": _HEADS}, {"alias": sheets.header_alias}, {"alias": f"CASE {_alias} END"})
_ROW = " || ' | ' || ".join([pick("'Name of the Instrument'", "p_name", "'Security'"), pick("'ISIN'", "p_type", key="p_size"), pick("'Quantity'", "'Market Value'", "'seeking income'", key="(p_partkey + p_size)"), pick("'% to NAV'", "'Rating'", "'x'", "'YTM'", key="(p_partkey * 3 + p_size)")])
_hints = " + ".join(f"{has('h', p)}::INTEGER" for p in sheets.HEADER_HINTS)
ruled("header_scores_of_rows", "How much rows of known words and parts' names look like headers.", {"h": _ROW}, {"score": lambda h: sheets.header_score(F.split(h, r" \| "))}, {"score": f"CASE WHEN {_hints} >= 2 THEN {_hints} + " + " + ".join(f"({n}) * {has('h', p)}::INTEGER" for n, p in sheets.HEADER_MORE) + " ELSE -1 END"})
ruled(
    "number_forms", "Numbers rounded half to even, shown without zeros at their ends, and weights read from text.",
    {"d": "(p_partkey * 1000003 % 20000003) / 10000000.0 - 1", "s": pick("p_size || '.25%'", "' 1,00' || p_size % 10 || ' '", "'NIL'", "''", "'x' || p_size", "'-0.' || p_size", "NULL")},
    {"rounded": lambda d, s: numbers.round6(d), "shown": lambda d, s: numbers.shown6(numbers.round6(d)), "weight": lambda d, s: numbers.check_weight(s)},
    {"rounded": "round_even(d::DECIMAL(38,12), 6)::DOUBLE", "shown": r"regexp_replace(regexp_replace(printf('%.6f', round_even(d::DECIMAL(38,12), 6)::DOUBLE), '0+$', ''), '\.$', '')", "weight": r"CASE WHEN regexp_matches(regexp_replace(trim(s), '[,%]', '', 'g'), '^[+-]?(\d+(\.\d*)?|\.\d+)$') THEN regexp_replace(trim(s), '[,%]', '', 'g')::DOUBLE END"},
)

# ---------------------------------------------------------------- days

_o = "o_orderkey"


def _days(name: str, doc: str, form: dict[str, Callable[[Column], Column]], form_sql: dict[str, str], rules: dict[str, Callable[[Column, Column], Column]], sql: dict[str, str]) -> None:
    """Rules over texts that name the orders' days, thirty years on."""

    def run(t):
        d = F.date_add(F.to_date("o_orderdate"), 10_957)
        rows = t.orders.select(_o, d.alias("d"), *[f(d).alias(n) for n, f in form.items()])
        return rows.select(_o, *[rule(F.col(next(iter(form))), F.col("d")).cast("string").alias(out) for out, rule in rules.items()])

    run.__doc__ = doc
    given = ", ".join(f"{x} AS {n}" for n, x in form_sql.items())
    out = ", ".join(f"CAST({x} AS VARCHAR) AS {n}" for n, x in sql.items())
    query(name, f"WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 10957 AS d FROM orders), x AS (SELECT o_orderkey, d, {given} FROM d) SELECT o_orderkey, {out} FROM x")(run)


_k = lambda n: F.col("o_orderkey") % n
def _k_in(x: Column) -> Column:
    return F.contains(x, F.lit("-"))


_NORMAL = "CASE WHEN regexp_matches(x, '^\\d{4}-\\d{2}$') THEN last_day(strptime(x || '-01', '%Y-%m-%d')::DATE) WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}$') THEN strptime(x, '%Y-%m-%d')::DATE WHEN contains(x, '/') THEN strptime(x, '%d/%m/%Y')::DATE WHEN regexp_matches(x, '^\\d{1,2} [A-Z][a-z]{2} \\d{4}$') THEN strptime(x, '%d %b %Y')::DATE END"
_days(
    "day_forms", "As-of parameters in several forms: normalised, strictly, as days of price lists, as day numbers, and under a folder's date.",
    {"x": lambda d: F.when(_k(6) == 0, F.date_format(d, "yyyy-MM-dd")).when(_k(6) == 1, F.date_format(d, "yyyy-MM")).when(_k(6) == 2, F.date_format(d, "d/M/yyyy")).when(_k(6) == 3, F.date_format(d, "d MMM yyyy")).when(_k(6) == 4, F.date_format(d, "d-MMM-yyyy")).otherwise("no day")},
    {"x": "CASE o_orderkey % 6 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN strftime(d, '%-d/%-m/%Y') WHEN 3 THEN strftime(d, '%-d %b %Y') WHEN 4 THEN strftime(d, '%-d-%b-%Y') ELSE 'no day' END"},
    {"normal": lambda x, d: dates.normalize_as_of(x), "strict": lambda x, d: dates.strict_as_of(x), "price_day": lambda x, d: dates.nav_date(x), "serial": lambda x, d: dates.serial_date(F.datediff(d, F.lit("1899-12-30").cast("date")) + F.when(_k_in(x), 0).otherwise(50_000)), "clamped": lambda x, d: dates.clamp_to_folder(d, dates.normalize_as_of(x))},
    {"normal": _NORMAL, "strict": "CASE WHEN regexp_matches(x, '^\\d{4}-\\d{2}$') THEN last_day(strptime(x || '-01', '%Y-%m-%d')::DATE)::VARCHAR WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}$') THEN x ELSE '' END", "price_day": "CASE WHEN regexp_matches(x, '^\\d{1,2}-[A-Z]') THEN strptime(x, '%d-%b-%Y')::DATE WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}') THEN strptime(x, '%Y-%m-%d')::DATE END", "serial": "CASE WHEN (d - DATE '1899-12-30') + CASE WHEN contains(x, '-') THEN 0 ELSE 50000 END BETWEEN 30000 AND 80000 THEN d END", "clamped": f"coalesce({_NORMAL}, d)"},
)
_MONTH_OF = "date_trunc('month', d)::DATE"
_days(
    "month_forms", "Labels that name two months or none: the last one, whether it is the wanted one, whether two digits are a year, and whether the label is stale.",
    {"x": lambda d: F.when(_k(5) == 0, F.concat(F.lit("Maturity APR 2028 book "), F.date_format(d, "MMM yyyy"))).when(_k(5) == 1, F.date_format(d, "MMMM-yyyy")).when(_k(5) == 2, F.concat(F.date_format(d, "MMM"), F.lit("_"), F.date_format(d, "dd"))).when(_k(5) == 3, F.lit("no month")).otherwise(F.concat(F.date_format(d, "MMM yyyy"), F.lit(", "), F.date_format(F.add_months(d, 1), "MMM yyyy")))},
    {"x": "CASE o_orderkey % 5 WHEN 0 THEN 'Maturity APR 2028 book ' || strftime(d, '%b %Y') WHEN 1 THEN strftime(d, '%B-%Y') WHEN 2 THEN strftime(d, '%b') || '_' || strftime(d, '%d') WHEN 3 THEN 'no month' ELSE strftime(d, '%b %Y') || ', ' || strftime(d + INTERVAL 1 MONTH, '%b %Y') END"},
    {"last": lambda x, d: dates.last_month(x), "wanted": lambda x, d: dates.month_match(dates.all_months(x), F.trunc(d, "MM")), "year": lambda x, d: dates.year_guard(x), "stale": lambda x, d: dates.stale_label(x, F.lit("2026-06"))},
    {"last": "try_strptime('1 ' || substr(list_last(regexp_extract_all(x, '(?i)[A-Z]{3,9}[ -]20\\d\\d')), 1, 3) || ' ' || right(list_last(regexp_extract_all(x, '(?i)[A-Z]{3,9}[ -]20\\d\\d')), 4), '%d %b %Y')::DATE", "wanted": f"CASE WHEN len(regexp_extract_all(x, '20\\d\\d')) > 0 THEN contains(lower(x), lower(strftime({_MONTH_OF}, '%b %Y'))) OR contains(x, strftime({_MONTH_OF}, '%B-%Y')) END", "year": "coalesce(try_cast(regexp_extract(x, '^[A-Za-z]+_(\\d\\d)$', 1) AS INTEGER) BETWEEN 20 AND 29, false)", "stale": "regexp_matches(replace(upper(x), ' ', ''), 'MAY|APR|MAR|JUL|31[-/]?JUL|JULY') AND NOT contains(replace(upper(x), ' ', ''), 'JUN')"},
)

# ---------------------------------------------------------------- likeness


@query("name_scores", f"""
WITH q AS (SELECT p_partkey AS k, p_name || ' ' || lower(p_type) || CASE WHEN p_partkey % 3 = 0 THEN ' fund of ' || p_size ELSE '' END AS n FROM part),
l AS (SELECT k AS id, k AS block, n FROM q), r AS (SELECT k AS id, k - 1 AS block, n FROM q), {_SCORED}
SELECT l.id AS p_partkey, round(s, 4) AS sort, round(t, 4) AS sets, round(p.p, 4) AS part, round(score, 4) AS mixed FROM l JOIN r USING (block) JOIN st ON st.x = l.n AND st.y = r.n JOIN p ON p.x = l.n AND p.y = r.n JOIN scored ON scored.x = l.n AND scored.y = r.n""")
def name_scores(t):
    """Each part's name against the next one's: sorted words, sets of words, best stretch, and the mixed score."""
    n = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" fund of "), F.col("p_size"))).otherwise(""))
    a = t.part.select("p_partkey", n.alias("a"))
    b = t.part.select((F.col("p_partkey") - 1).alias("p_partkey"), n.alias("b"))
    r = lambda c: F.round(c, 4)
    return a.join(b, "p_partkey").select("p_partkey", r(S.token_sort_ratio("a", "b")).alias("sort"), r(S.token_set_ratio("a", "b")).alias("sets"), r(S.partial_ratio("a", "b")).alias("part"), r(S.name_match_score("a", "b")).alias("mixed"))


# ---------------------------------------------------------------- landed listings

_SLICE = "CASE WHEN day({0}) BETWEEN 13 AND 16 THEN date_trunc('month', {0})::DATE + 14 WHEN day({0}) >= 27 OR day({0}) >= day(last_day({0})) - 3 THEN last_day({0}) END"
_LANDED = """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 10957 AS d FROM orders),
x AS (SELECT o_orderkey, d, o_orderkey % 9 AS v, 'https://h.org/' || CASE o_orderkey % 9 WHEN 0 THEN 'Portfolio ' || strftime(d, '%d-%b-%Y') || '.xlsx' WHEN 1 THEN 'Weekly ' || strftime(d, '%b %Y') || '.xls' WHEN 2 THEN 'Half-Yearly Portfolio ' || strftime(d, '%b %Y') || '.xlsx' WHEN 3 THEN 'Consolidated SEBI Portfolio ' || strftime(d, '%b %Y') || '.zip?x=1'
    WHEN 4 THEN 'Portfolio ' || strftime(d, '%b %Y') || '.pdf' WHEN 5 THEN 'Portfolio.xlsx' WHEN 6 THEN 'weekly-and-monthly ' || strftime(d, '%b %Y') || '.csv' WHEN 7 THEN 'slug' || o_orderkey || '.xlsm' ELSE 'Book ' || strftime(d, '%d-%b-%Y') || '.xlsx' END AS url,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE date_trunc('month', d + CASE WHEN o_orderkey % 4 = 0 THEN 31 ELSE 0 END)::DATE END AS period, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN last_day(d) ELSE date_trunc('month', d)::DATE + 14 END AS slice, o_orderkey % 11 = 0 AS trusted FROM d)"""


def _landed(t):
    k, d = F.col("o_orderkey"), F.date_add(F.to_date("o_orderdate"), 10_957)
    on = lambda f: F.date_format(d, f)
    forms = [F.concat(F.lit("Portfolio "), on("dd-MMM-yyyy"), F.lit(".xlsx")), F.concat(F.lit("Weekly "), on("MMM yyyy"), F.lit(".xls")), F.concat(F.lit("Half-Yearly Portfolio "), on("MMM yyyy"), F.lit(".xlsx")), F.concat(F.lit("Consolidated SEBI Portfolio "), on("MMM yyyy"), F.lit(".zip?x=1")), F.concat(F.lit("Portfolio "), on("MMM yyyy"), F.lit(".pdf")), F.lit("Portfolio.xlsx"), F.concat(F.lit("weekly-and-monthly "), on("MMM yyyy"), F.lit(".csv")), F.concat(F.lit("slug"), k, F.lit(".xlsm")), F.concat(F.lit("Book "), on("dd-MMM-yyyy"), F.lit(".xlsx"))]
    url = F.concat(F.lit("https://h.org/"), F.element_at(F.array(*forms), (k % 9 + 1).cast("int")))
    period = F.when(k % 7 > 0, F.trunc(F.date_add(d, F.when(k % 4 == 0, 31).otherwise(0)), "MM"))
    key = F.when(k % 3 == 0, F.lit(None).cast("date")).when(k % 2 == 0, F.last_day(d)).otherwise(dates.fifteenth(d))
    return t.orders.select("o_orderkey", d.alias("d"), url.alias("url"), period.alias("period"), key.alias("slice"), (k % 11 == 0).alias("trusted"))


@query("landed_file_reasons", _LANDED + rf""",
y AS (SELECT *, try_strptime(regexp_extract(url, '\d\d-[A-Z][a-z][a-z]-\d{{4}}'), '%d-%b-%Y')::DATE AS named, try_strptime('1 ' || replace(regexp_extract(url, '[A-Z][a-z][a-z][ -]20\d\d'), '-', ' '), '%d %b %Y')::DATE AS month FROM x)
SELECT o_orderkey, CASE WHEN NOT regexp_matches(url, '{classify.SPREADSHEET}', 'i') THEN 'not_spreadsheet' WHEN regexp_matches(url, '{classify.NO_PORTFOLIO}', 'i') AND NOT regexp_matches(url, '{classify.CONSOLIDATED}', 'i') THEN 'excluded_non_portfolio' WHEN regexp_matches(url, 'weekly', 'i') AND NOT regexp_matches(url, 'monthly|fortnight', 'i') THEN 'weekly_not_portfolio' WHEN trusted THEN 'adapter_period'
  WHEN period IS NOT NULL AND month <> period THEN 'wrong_month' WHEN slice IS NOT NULL AND named IS NOT NULL AND coalesce({_SLICE.format('named')} = slice, false) THEN 'as_of_slice' WHEN slice IS NOT NULL AND named IS NOT NULL THEN 'wrong_as_of_slice' WHEN period IS NOT NULL AND month = period THEN 'month_in_name' WHEN slice IS NOT NULL THEN 'undated_no_month' ELSE 'spreadsheet_on_disclosure_page' END AS reason FROM y""")
def landed_file_reasons(t):
    """Why landed files named after orders' days are kept or not, for wanted months and slices that fit some."""
    x = _landed(t)
    u = F.col("url")
    return x.select("o_orderkey", classify.file_reason(u, F.lit(None).cast("string"), dates.extract_dates(u), dates.all_months(u), dates.matches_as_of(u, F.col("slice")), F.col("period"), F.col("slice"), F.col("trusted")).alias("reason"))


@query("landed_days", _LANDED + f""",
f AS (SELECT *, 'https://h.org/2026/a_' || CASE o_orderkey % 3 WHEN 0 THEN strftime(d, '%d%m%Y') WHEN 1 THEN strftime(d, '%d%m%y') ELSE o_orderkey::VARCHAR || 'x' END || '.xlsx' AS file, CASE o_orderkey % 4 WHEN 0 THEN epoch_ms(d::TIMESTAMP)::VARCHAR WHEN 1 THEN '/Date(' || epoch_ms(d::TIMESTAMP) || '+0000)/' WHEN 2 THEN 'soon' END AS published, CASE WHEN o_orderkey % 5 = 0 THEN 'Portfolio ' || strftime(d, '%b %Y') ELSE 'Portfolio' END AS title FROM x)
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 < 2 AND (day(d) = 15 OR day(d) >= 28) THEN d END AS VARCHAR) AS compact, CAST(CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 4 < 2 THEN date_trunc('month', d)::DATE END AS VARCHAR) AS month, contains(regexp_replace(file, '[^0-9A-Za-z]', '', 'g'), strftime(d, '%d%m%Y')) AS token,
  CAST(CASE WHEN o_orderkey % 9 IN (0, 8) AND {_SLICE.format('d')} IS NOT NULL THEN CASE WHEN day(d) <> day({_SLICE.format('d')}) THEN d ELSE {_SLICE.format('d')} END ELSE coalesce({_SLICE.format('d')}, CASE WHEN o_orderkey % 9 IN (0, 8) THEN d END) END AS VARCHAR) AS chosen,
  NOT contains(url, 'zip') AS single FROM f""")
def landed_days(t):
    """Days that files' digits give, months that titles or publication times give, tokens of a day, the choice between sheet's and name's day, and files within a scope."""
    k, d = F.col("o_orderkey"), F.col("d")
    x = _landed(t)
    ms = F.unix_millis(d.cast("timestamp")).cast("string")
    file = F.concat(F.lit("https://h.org/2026/a_"), F.when(k % 3 == 0, F.date_format(d, "ddMMyyyy")).when(k % 3 == 1, F.date_format(d, "ddMMyy")).otherwise(F.concat(k, F.lit("x"))), F.lit(".xlsx"))
    published = F.when(k % 4 == 0, ms).when(k % 4 == 1, F.concat(F.lit("/Date("), ms, F.lit("+0000)/"))).when(k % 4 == 2, "soon")
    title = F.when(k % 5 == 0, F.concat(F.lit("Portfolio "), F.date_format(d, "MMM yyyy"))).otherwise("Portfolio")
    name = F.regexp_extract("url", r"([^/]+)$", 1)
    named = F.when((k % 9).isin(0, 8), dates.parse_as_of(name))
    return x.select("o_orderkey", landed.compact_day(file).cast("string").alias("compact"), landed.month_of_row(title, published).cast("string").alias("month"), landed.names_day(file, d).alias("token"), dates.choose_as_of(dates.filing_slice(d), named, name).cast("string").alias("chosen"), landed.in_scope(F.col("url"), "single").alias("single"))


_PAGE = "'<div id=\"one\"><ul><li><b>Old</b><span>' || page_id || ' file</span><a href=\"/f/' || (page_id % 7) || '.xlsx\">f</a></li></ul></div><div id=\"two\">' || url || '</div>'"


@query("landed_pages", f"""
WITH x AS (SELECT page_id, url, {_PAGE} AS h FROM pages)
SELECT page_id, split_part(split_part(h, 'id="one"', 2), 'id="two"', 1) AS tab, page_id || ' file' AS label, 'l' || (page_id % 3) || '=u' || (page_id % 5) || CASE WHEN page_id % 3 <> page_id % 4 AND page_id % 5 <> page_id % 6 THEN ',l' || (page_id % 4) || '=u' || (page_id % 6) ELSE '' END AS zipped, CASE WHEN page_id % 2 = 0 THEN page_id || ',' || (page_id + 1) ELSE page_id::VARCHAR END AS lines,
  CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://h.org/f/' || page_id ELSE 'https://h.org/g' || page_id END AS address FROM x WHERE url LIKE 'http%'""")
def landed_pages(t):
    """Parts of landed pages: what stands in a tab, the last label before a link, labels and links by position, rows of lines of JSON, the first address of several fields."""
    k = F.col("page_id")
    h = F.expr(_PAGE)
    item = F.regexp_extract(h, "(<li>.*</li>)", 1)
    text = lambda *xs: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in xs])
    labels = F.array(text("l", k % 3), text("l", k % 4), text("l", k % 3))
    links = F.array(text("u", k % 5), text("u", k % 6))
    lines = text('0:{"u":"', k, '"}\n1:[1]\nx', F.when(k % 2 == 0, text('\n2:{"u":"', k + 1, '"}')).otherwise(""))
    fields = [F.when(k % 3 == 0, F.col("url")), F.when(k % 3 == 1, text("//f/", k)).otherwise(" "), text("g", k)]
    got = F.array_join(F.transform(landed.json_lines(lines, "u string"), lambda r: r["u"]), ",")
    return t.pages.where("url like 'http%'").select("page_id", landed.between(h, 'id="one"', 'id="two"').alias("tab"), landed.last_label(item).alias("label"), F.array_join(landed.zipped(labels, links), ",").alias("zipped"), got.alias("lines"), landed.first_address("https://h.org", *fields).alias("address"))


@query("source_cadences", r"""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 10957 AS d FROM orders),
x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN last_day(d) ELSE date_trunc('month', d)::DATE + 14 END AS slice, CASE WHEN o_orderkey % 3 = 0 THEN 'monthly' ELSE 'fortnightly' END AS kind,
  CASE o_orderkey % 7 WHEN 0 THEN 'Fortnightly portfolio 15 ' || strftime(d, '%b %Y') || '.xlsx' WHEN 1 THEN 'Monthly portfolio ' || strftime(d, '%b %Y') || '.xlsx' WHEN 2 THEN 'debt_31-' || strftime(d, '%b-%Y') || '.xlsx' WHEN 3 THEN 'debt 15-' || strftime(d, '%b-%Y') || '.xlsx' WHEN 4 THEN 'in_mf_monthly_' || strftime(d, '%m') || '.xls' WHEN 5 THEN 'equity exposure.xls' END AS s FROM d)
SELECT o_orderkey, NOT (s IS NOT NULL AND ((kind = 'monthly' AND slice = last_day(slice) AND o_orderkey % 7 = 0) OR (kind = 'fortnightly' AND day(slice) = 15 AND o_orderkey % 7 IN (1, 2, 4, 5) AND NOT (o_orderkey % 7 = 1 AND NOT contains(lower(s), 'monthly portfolio'))))) AS fits FROM x""")
def source_cadences(t):
    """Whether sources' names go with the slices that they are filed under."""
    k, d = F.col("o_orderkey"), F.date_add(F.to_date("o_orderdate"), 10_957)
    on = lambda f: F.date_format(d, f)
    s = F.when(k % 7 == 0, F.concat(F.lit("Fortnightly portfolio 15 "), on("MMM yyyy"), F.lit(".xlsx"))).when(k % 7 == 1, F.concat(F.lit("Monthly portfolio "), on("MMM yyyy"), F.lit(".xlsx"))).when(k % 7 == 2, F.concat(F.lit("debt_31-"), on("MMM-yyyy"), F.lit(".xlsx"))).when(k % 7 == 3, F.concat(F.lit("debt 15-"), on("MMM-yyyy"), F.lit(".xlsx"))).when(k % 7 == 4, F.concat(F.lit("in_mf_monthly_"), on("MM"), F.lit(".xls"))).when(k % 7 == 5, "equity exposure.xls")
    slice_ = F.when(k % 2 == 0, F.last_day(d)).otherwise(dates.fifteenth(d))
    return t.orders.select("o_orderkey", dates.source_fits_cadence(s, slice_, F.when(k % 3 == 0, "monthly").otherwise("fortnightly")).alias("fits"))
