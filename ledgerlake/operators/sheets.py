"""Sheets of cells to holdings: header choice, section carry, blocks, and the row-by-row table parser.

A grid has columns file, sheet, row_no, cells. Row order is data.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, names
from ..rules import has, ordered_case

MAX_HEADER_ROW = 120

# Header words by canonical column, tried in this order
HEADER_ALIASES = {
    "security_code": r"^\s*(security\s*)?(code|no\.?)\s*$|^\s*sr\.?\s*no|^\s*scrip\s*code|^\s*sl\s*no",
    "instrument": r"name\s+of\s+(the\s+)?(instrument|security|issuer)|company\s*/?\s*issuer\s*/?\s*instrument|instrument\s*/?\s*issuer|security\s+name|^(security|instrument|scrip)\b",
    "isin": r"^\s*isin\b|isin\s*code",
    "coupon": r"\bcoupon\b",
    "ytm": r"\bytm\b|yield\s*to\s*maturity",
    "ytc": r"\bytc\b|yield\s*to\s*call|at1|tier\s*2",
    "instrument_yield": r"\byield\b",
    "residual_maturity": r"residual|remaining\s*maturity|\btenor\b",
    "maturity_date": r"maturity\s*date|date\s*of\s*maturity|redemption\s*date|(?<!to )\bmaturity\b",
    "face_value": r"face\s*value|par\s*value",
    "put_call_date": r"put\s*/?\s*call|call\s*date|put\s*date",
    "industry_rating": r"industry\s*[\^+\*]?\s*/\s*rating|rating\s*/\s*industry|industry\s+classification\s*/\s*rating",
    "rating_agency": r"rating\s*agency",
    "rating": r"credit\s*rating|^\s*rating\b|conservative\s+rating",
    "industry": r"\bindustry\b|\bsector\b",
    "quantity": r"^\s*quantity\b|\bqty\b|no\.?\s*of\s*(shares|units)|hedged\s+quantity",
    "futures_price": r"(futures?|option|contract)\s+price|current\s+price\s+of\s+the\s+contract",
    "market_value": r"market\s*/?\s*fair\s*value|market[\s\-]*value|mkt\.?\s*[\-]?\s*val(?:ue)?|exposure\s*/\s*market|value\s*\(.*?(rs|inr|lakh)|value\s+recognised\s+in\s+nav",
    "pct_nav": r"%\s*(to|of)?\s*(n\.?a\.?v|aum|net\s*assets?)|percent(age)?\s*(to|of)?\s*(n\.?a\.?v|aum|net\s*assets?)",
    "macaulay_duration": r"macaulay",
    "modified_duration": r"modified\s*duration",
    "duration": r"\bduration\b",
    "listed_status": r"listed\s*status|\blisted\b|\bunlisted\b",
    "accrued_interest": r"accrued\s*interest|interest\s*accrued",
    "position_side": r"long\s*/\s*\(?\s*short",
    "margin": r"^\s*margin\b|margin\s+maintained",
    "market_cap": r"market\s*capital",
    "underlying": r"^\s*underlying\b",
    "asset_class": r"asset\s*(class|type)|type of security",
}
# Words that mark a header row, what else tells one and how much, and words of marketing text
HEADER_HINTS = (r"\bisin\b", r"\binstrument\b", r"\bsecurity\b", r"\bquantity\b", r"\bmarket\b", r"%\s*to", r"\bnav\b", r"\baum\b", r"\bindustry\b", r"\brating\b", r"\bytm\b")
MARKETING = r"(?:^[•\-\*]|\bseeking\b|investors?\s+who|consult\s+their|suitable\s+for|riskometer|potential\s+risk\s+class)"
HEADER_MORE = ((8, r"\bisin\b"), (6, r"%\s*(to|of)|percent|%\s*nav|%\s*to\s*net"), (4, r"name\s+of\s+(the\s+)?(instrument|security)"), (2, r"\bquantity\b"), (-12, MARKETING))
STOP = r"^\s*(?:grand\s+total|total\s+net\s+assets?|net\s+assets?\s*$|notes?\s*:|disclaimers?|portfolio\s+turnover)"
TOTAL = r"^\s*(?:sub[\s-]*)?totals?\b"
SECTION = r"^\s*(?:\(?[a-z0-9]{1,3}\)|[ivx]+\.)?\s*(?:equity|debt|money\s+market|others?|derivatives?|futures?|options?|mutual\s+fund|cash|treps?|gold|silver|commodit|government|listed|unlisted)"
ISIN = r"^[A-Z]{2}[A-Z0-9]{9}\d$"


def header_score(cells: Column) -> Column:
    """How much a row looks like the table's header; at least two hints are needed."""
    t = F.array_join(F.filter(cells, lambda c: F.length(F.trim(c)) > 0), " | ")
    hints = sum((has(t, h).cast("int") for h in HEADER_HINTS), F.lit(0))
    more = sum((n * has(t, p).cast("int") for n, p in HEADER_MORE), F.lit(0))
    return F.when(hints >= 2, hints + more).otherwise(-1)


def header_alias(header: Column) -> Column:
    """The canonical name of one header cell, or null."""
    return ordered_case([(has(header, p), k) for k, p in HEADER_ALIASES.items()])


def header_rows(grid: DataFrame, keys: list[str], row_no: str, score: Column, good: int = 10, least: int = 2) -> DataFrame:
    """The header's row of each sheet: the first with a good score, else the first of the best."""
    s = grid.withColumn("__s", score)
    first_good = F.min(F.when(F.col("__s") >= good, F.col(row_no)))
    best = F.max(F.when(F.col("__s") >= least, F.struct(F.col("__s").alias("s"), (-F.col(row_no)).alias("n"))))
    return s.groupBy(*keys).agg(F.coalesce(first_good, -best["n"]).alias("header_row"))


def carry_down(df: DataFrame, keys: list[str], order: str, marker: Column, out: str) -> DataFrame:
    """The last marker seen so far."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(marker, ignorenulls=True).over(w))


def blocks(df: DataFrame, keys: list[str], order: str, opens: Column, out: str) -> DataFrame:
    """Number the blocks that marker rows open (0: before the first)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.coalesce(opens, F.lit(False)).cast("int")).over(w))


def trim_after(df: DataFrame, keys: list[str], order: str, stop: Column) -> DataFrame:
    """Rows before the first stop row of each group."""
    w = Window.partitionBy(*keys)
    return df.withColumn("__stop", F.min(F.when(stop, F.col(order))).over(w)).where(F.col("__stop").isNull() | (F.col(order) < F.col("__stop"))).drop("__stop")


# Banners of a portfolio's date, weaker labels, and rows whose dates are another's
STRONG_BANNER = r"portfolio\s+statement\s+as\s+o[nf]|holdings?\s+as\s+o[nf]|(?:monthly|fortnightly)\s+portfolio\s+as\s+o[nf]|portfolio\s+disclosure\s+as\s+o[nf]|scheme\s+portfolio\s+as\s+o[nf]"
WEAK_LABEL = r"as\s*on|as\s*of|as\s*at|month\s+ended|period\s+ended|(?:monthly|fortnightly|half[\s-]?yearly)?\s*portfolio\s+statement|portfolio\s+(?:disclosure\s+)?as\s+o[nf]|holdings?\s+as\s+o[nf]"
NOT_AS_OF = r"nav\s+(?:histrory|history)|dividend\s+history|nav\s+rs\.?\s+per\s+unit\s+as\s+on|inception\s+date|date\s+of\s+allotment"
AS_OF_ROWS = 40


def row_as_of(cells: Column) -> Column:
    """The date that a labelled row tells: of the row as a whole, else of its first cell that tells one (a bare day number counts)."""
    joined = F.array_join(F.filter(cells, lambda c: F.length(c) > 0), " | ")
    quiet = F.filter(cells, lambda c: (F.length(c) > 0) & ~has(c, NOT_AS_OF))
    each = F.transform(quiet, lambda c: F.coalesce(dates.serial_date(F.regexp_extract(c, r"^(\d{5})(?:\.\d+)?$", 1).try_cast("int")), dates.parse_as_of(c)))
    first = F.try_element_at(F.filter(each, lambda d: d.isNotNull()), F.lit(1))
    return F.when(has(joined, WEAK_LABEL) & ~has(joined, NOT_AS_OF), F.coalesce(dates.parse_as_of(joined), first))


def first_as_of(day: str, joined: str, row_no: str) -> Column:
    """Of a sheet's rows with a day: the first strong banner's, else the first weak label's."""
    return F.min_by(day, F.when(F.col(day).isNotNull(), F.struct((~has(F.col(joined), STRONG_BANNER)).cast("int"), row_no)))


def joined_cells(cells: Column) -> Column:
    return F.array_join(F.filter(cells, lambda c: F.length(c) > 0), " | ")


def sheet_as_of(grid: DataFrame, keys: list[str], row_no: str = "row_no") -> DataFrame:
    """Each sheet's as-of date, from its first rows."""
    told = grid.where(F.col(row_no) < AS_OF_ROWS).withColumn("__j", joined_cells(F.col("cells"))).where(has("__j", WEAK_LABEL))
    return told.withColumn("__d", row_as_of(F.col("cells"))).groupBy(*keys).agg(first_as_of("__d", "__j", row_no).alias("as_of"))


TITLE_ROWS = 12


def row_title(cells: Column) -> Column:
    """The scheme that a row names: in its first cell that names one, or what a statement banner names."""

    def title(c: Column) -> Column:
        cell = F.trim(c)
        named = F.nullif(F.regexp_replace(F.regexp_extract(cell, r"(?i)portfolio\s+statement\s+of\s+(.+?)\s+as\s+on\b", 1), r"^[ \-–—]+|[ \-–—]+$", ""), F.lit(""))
        noise = has(cell, r"registration\s+no|registered\s+office|toll\s+free|mutual\s+fund$|open\s+ended|name\s+of\s+the\s+instrument|portfolio\s+(statement|as\s+on)")
        fund = has(cell, r"\b(fund|etf|fof|index|scheme|liquid|overnight|arbitrage|momentum|quality|nifty|sensex|nasdaq)\b") & (header_score(F.array(cell)) < 0)
        return F.coalesce(F.when(~has(named, r"registration\s+no"), named), F.when(~noise & fund, cell))

    long = F.filter(cells, lambda c: F.length(F.trim(c)) >= 6)
    return F.try_element_at(F.filter(F.transform(long, title), lambda t: t.isNotNull()), F.lit(1))


def title_of(grid: DataFrame, keys: list[str], row_no: str = "row_no") -> DataFrame:
    """Each sheet's scheme title: that of the first of its first rows that names one."""
    rows = grid.where(F.col(row_no) < TITLE_ROWS).withColumn("__t", row_title(F.col("cells")))
    return rows.groupBy(*keys).agg(F.min_by("__t", F.when(F.col("__t").isNotNull(), F.col(row_no))).alias("title"))


def sheet_shortcode(tab: Column, a1: Column, b1: Column) -> Column:
    """A scheme's short code: a tab that is one, else the first two cells, else a tab that is a label."""
    generic = has(tab, names.JUNK)
    code = lambda c: F.when(names.is_shortcode(F.upper(F.trim(c))) & F.trim(c).rlike("^[A-Z0-9]+$"), F.trim(c))
    label = F.when(~generic & (F.length(F.trim(tab)) >= 4) & tab.rlike("[A-Za-z]{3}"), F.trim(tab))
    return F.coalesce(F.when(~generic, code(tab)), code(a1), code(b1), label)


_ALIAS = [(k, re.compile(p, re.I)) for k, p in HEADER_ALIASES.items()]


def alias_headers(headers: list[str]) -> list[str]:
    """Canonical names, each used once; other headers as cleaned words, numbered where they recur."""
    used: set[str] = set()
    out = []
    for h in headers:
        name = next((k for k, p in _ALIAS if k not in used and p.search(h or "")), None)
        if name is None:
            stem = re.sub(r"[^a-z0-9]+", "_", (h or "").lower()).strip("_") or "column"
            n, name = 2, stem
            while name in used:
                name, n = f"{stem}_{n}", n + 1
        used.add(name)
        out.append(name)
    return out


_COLUMNS = ("instrument", "isin", "industry", "industry_rating", "rating", "rating_agency", "quantity", "market_value", "pct_nav", "coupon", "ytm", "ytc", "instrument_yield", "residual_maturity", "maturity_date", "face_value", "put_call_date", "futures_price", "security_code")
PARSED = "file string, sheet string, ordinal int, section string, implied boolean, raw map<string,string>, " + ", ".join(f"{c} string" for c in _COLUMNS)

# Words by which the parser tells rows apart
_R = {
    k: re.compile(p, re.I)
    for k, p in {
        "stop": STOP, "total": TOTAL, "section": SECTION, "named": r"name\s+of\s+(the\s+)?(instrument|security)|^\s*(instrument|security)\b", "percent": r"%\s*(to|of|age)|percent",
        "contract": r"^(futures?|options?)\s*$", "assets": r"^net\s+current\s+assets|^net\s+receivables", "cash": r"^(?:\(?[a-z0-9]+\)\s+)?(?:treps|tri[- ]?party|cblo|cash|net\s+current|net\s+receivables|nca\b)\b|^\(?[a-z0-9]+\)\s+repo\b",
        "repo": r"^reverse\s+repo\s*$", "repos": r"^reverse\s+repos?\b", "dated_repo": r"^reverse\s+repo\s*\(", "next_sleeve": r"^(total|sub\s*total|grand|triparty|treps|corporate\s+bond|money\s+market|others?|net\s+current|cash\s+margin|units\s+of)\b",
        "derivative": r"\bfutures?\b|\boptions?\b|derivative", "category": r"instruments?$|exchanges?$|securities$|bills$|bonds?$|papers?$|deposits?$|debentures?$|\bfunds?\b|\baif\b", "coupon": r"^\d+(\.\d+)?\s*%|\brepo\s+in\b",
        "subtotal": r"^sub\s*total\b", "childless": r"\bfutures?\b|treps?|tri[\s\-]?party|reverse\s+repo|\bcblo\b",
        "grand": r"grand\s+total", "net_assets": r"(total\s+)?net\s+assets?",
    }.items()
}
_ISIN = re.compile(ISIN)
_ANY_ISIN = re.compile(r"\b([A-Z]{2}[A-Z0-9]{9}\d)\b")
_NIL = re.compile(r"^\s*(?:nil|na|n\.a\.?|-|--)?\s*$", re.I)
_CODE = re.compile(r"[A-Za-z0-9./\-]{1,16}")
CONTRACT_ROWS, REPO_ROWS = 8, 30


_GAPS, _NUMBER = re.compile(r"[,%\s]"), re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?")


def _number(s: str | None) -> float | None:
    s = _GAPS.sub("", s or "")
    return float(s) if _NUMBER.fullmatch(s) else None


_HINT = [re.compile(h, re.I) for h in HEADER_HINTS]
_MORE = [(n, re.compile(p, re.I)) for n, p in HEADER_MORE]


def _score(cells: list[str]) -> int:
    """``header_score`` of one row inside the parser."""
    t = " | ".join(c for c in cells if c and c.strip())
    hints = sum(bool(h.search(t)) for h in _HINT)
    return -1 if hints < 2 else hints + sum(n for n, p in _MORE if p.search(t))


def _lead(cells: list[str]) -> str:
    return next((c for c in cells if c), "")


class _Sheet:
    """One sheet's rows and the state that carries from row to row: bound columns, section, holdings so far."""

    def __init__(self, rows: list[list[str]], leading_code: bool):
        self.rows = [[(c or "").strip() for c in r] for r in rows]
        self.leading_code, self.names, self.section, self.out = leading_code, [], "", []
        self.total = self._stated_total()

    def _stated_total(self) -> float | None:
        """The book's value as a total row tells it: grand total before net assets before totals; ties by size."""
        best = (0, 0.0)
        for cells in self.rows:
            lead = _lead(cells)
            rank = 3 if _R["grand"].search(lead) else 2 if _R["net_assets"].fullmatch(lead) else 0
            numbers = [n for n in map(_number, cells[1:]) if n is not None] if rank else []
            if len(numbers) > 1 and (rank, abs(numbers[0])) > best:
                best = (rank, abs(numbers[0]))
        return best[1] or None

    def header(self) -> int | None:
        best = (-1, 0)
        for i, r in enumerate(self.rows[:MAX_HEADER_ROW]):
            score = _score(r)
            if score >= 10:
                return i
            if score > best[0]:
                best = (score, i)
        return best[1] if best[0] >= 2 else None

    def bind(self, cells: list[str]) -> None:
        self.names = alias_headers([c or f"col_{i + 1}" for i, c in enumerate(cells)])
        at = {n: i for i, n in enumerate(self.names)}
        if self.leading_code and "security_code" not in at and at.get("isin") == 2 and at.get("instrument", 0) == 0:
            # a code without a header stands before the name
            self.names = ["security_code", "instrument", *self.names[2:]]

    def again(self, cells: list[str], at: int) -> bool | None:
        """None: no header. Else whether the table that it opens holds holdings too, or contracts within a few rows."""
        filled = [c for c in cells if c]
        joined = " | ".join(filled)
        # the score, of many patterns, comes last
        if not self.out or len(filled) < 3 or not _R["named"].search(joined) or not (re.search(r"\bisin\b", joined, re.I) or _R["percent"].search(joined)) or _score(cells) < 0:
            return None
        new = set(alias_headers(cells))
        if {"pct_nav", "instrument"} <= new and new & {"isin", "market_value"}:
            return True
        for row in self.rows[at + 1 : at + 1 + CONTRACT_ROWS]:
            lead = _lead(row)
            if _R["contract"].match(lead):
                return True
            if lead and (_R["stop"].search(lead) or re.match(r"total\s*:", lead, re.I)):
                break
        return False

    def has_metrics(self, got: dict, cells: list[str]) -> bool:
        if any(_number(got.get(c)) is not None for c in ("quantity", "market_value", "pct_nav")) or got.get("pct_nav") == "*":
            return True
        return any(_number(c) is not None for c in cells[1:])

    def dated_children(self, at: int) -> bool:
        """Whether dated repos follow a sleeve's total before the next sleeve."""
        for row in self.rows[at + 1 : at + 1 + REPO_ROWS]:
            lead = dict(zip(self.names, row)).get("instrument") or _lead(row)
            if _R["dated_repo"].match(lead):
                return True
            if _R["next_sleeve"].match(lead):
                return False
        return False

    def read(self) -> list[dict]:
        head = self.header()
        if head is None:
            return []
        self.bind(self.rows[head])
        for at in range(head + 1, len(self.rows)):
            cells = self.rows[at]
            lead = _lead(cells)
            if not lead:
                continue
            if _R["stop"].search(lead):
                break
            more = self.again(cells, at)
            if more is False:
                break
            if more:
                self.bind(cells)
                self.section = ""
                continue
            self.row(cells, lead, at)
        return self.out

    def row(self, cells: list[str], lead: str, at: int) -> None:
        got = dict(zip(self.names, cells))
        found = _ANY_ISIN.search(got.get("isin", "")) or _ANY_ISIN.search(" | ".join(cells))
        isin, metrics = found.group(1) if found else "", self.has_metrics(got, cells)
        name = got.get("instrument") or lead
        if self.leading_code and found and _CODE.fullmatch(name) and not _ANY_ISIN.search(got.get("isin", "")) and len(cells) > 2:
            # the whole row is shifted by a code
            got = dict(zip(["security_code", *self.names], cells))
            name = got.get("instrument") or name
        if not isin and not metrics:
            if not _R["total"].search(lead) and (_R["section"].search(lead) or sum(map(bool, cells)) == 1):
                self.section = lead
            return
        if not isin and _R["assets"].search(name):
            self.compact(got, cells)
        if _R["total"].search(name) or _NIL.match(name):
            if not (_R["subtotal"].match(name) and _R["childless"].search(self.section) and not any(r["section"] == self.section for r in self.out)):
                return
            name = self.section  # a weighted total without rows of its own
        value, weight = _number(got.get("market_value")), _number(got.get("pct_nav"))
        if not isin and not got.get("quantity") and value is not None and (weight is not None or got.get("pct_nav") == "*") and self.sleeve(name, at):
            self.section = name
            return
        if not isin and not any(not _NIL.match(got.get(c) or "") for c in ("quantity", "market_value", "pct_nav")):
            return
        self.keep(got, name, isin, value, weight)

    def compact(self, got: dict, cells: list[str]) -> None:
        """Name, value, weight without the columns between: the last two numbers."""
        numbers = [c.replace(",", "") for c in cells[1:] if _number(c) is not None and not c.endswith("%")]
        if len(numbers) >= 2 and (_number(got.get("market_value")) is None or _number(got.get("pct_nav")) is None):
            got["market_value"], got["pct_nav"] = numbers[-2:]
            got["quantity"] = got["industry"] = ""
        elif len(numbers) == 1 and not got.get("pct_nav"):
            got["pct_nav"] = numbers[0]
            got["quantity"] = got["industry"] = ""

    def sleeve(self, name: str, at: int) -> bool:
        """Whether a row with a value and a weight is the total of a category whose rows follow."""
        if _R["cash"].search(name):
            return False
        if _R["repo"].match(name):
            return self.dated_children(at)
        if _R["derivative"].search(name):
            return False
        return bool(_R["section"].search(name) and not _R["repos"].match(name)) or bool(_R["category"].search(name) and not _R["coupon"].search(name))

    def keep(self, got: dict, name: str, isin: str, value: float | None, weight: float | None) -> None:
        shown, implied = got.get("pct_nav") or "", False
        if (not shown or shown == "*") and self.total and value is not None:
            prior = [abs(w) for w in (_number(r["pct_nav"]) for r in self.out) if w is not None]
            share = value / self.total * (1.0 if prior and max(prior) <= 1.5 else 100.0)
            shown, implied = f"{share:.10f}".rstrip("0").rstrip("."), True
        row = {c: got.get(c) or None for c in _COLUMNS}
        row |= {"instrument": name, "isin": isin or None, "section": self.section or None, "implied": implied, "ordinal": len(self.out), "raw": {k: v for k, v in got.items() if v}}
        row["market_value"] = None if _NIL.match(got.get("market_value") or "") else got["market_value"]
        row["pct_nav"] = None if _NIL.match(shown) else shown
        self.out.append(row)


def parse_sheet(rows: list[list[str]], leading_code: bool = False) -> list[dict]:
    """Holdings of one sheet, row by row.

    A second header opens another table of holdings, or of contracts if one is named within ``CONTRACT_ROWS`` rows,
    else it ends the sheet. A category's total opens a section, "Reverse Repo" only if dated ones follow within
    ``REPO_ROWS`` rows. Weights that are missing or "*" follow from the stated total. ``leading_code``: a code
    without a header may stand before the name.
    """
    return _Sheet(rows, leading_code).read()


def parsed_groups(rows: DataFrame, keys: list[str], leading: str | None = None) -> DataFrame:
    """Holdings of every group of rows (keys, row_no, cells), sorted and streamed; one group is held at a time. ``leading`` names the column that tells whether codes may stand before names."""
    types, parsed = dict(rows.dtypes), PARSED.split(", ")[2:]
    names = [x.split()[0] for x in parsed]
    kinds = [{"int": pa.int32(), "boolean": pa.bool_(), "map<string,string>": pa.map_(pa.string(), pa.string())}.get(x.split()[1], pa.string()) for x in parsed]

    def told(key_types, groups: list, found: list) -> pa.RecordBatch:
        arrays = [pa.array([g[k] for g in groups], t) for k, t in enumerate(key_types)]
        arrays += [pa.array([list(r[n].items()) for r in found] if n == "raw" else [r[n] for r in found], t) for n, t in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, *names])

    def run(batches):
        at, held, coded, groups, found, key_types = None, [], False, [], [], None
        for b in batches:
            key_types = key_types or [c.type for c in b.columns[: len(keys)]]
            own = zip(*(c.to_pylist() for c in b.columns[: len(keys)]))
            lead = b.column(len(keys) + 1).to_pylist() if leading else [False] * b.num_rows
            for group, cells, code in zip(own, b.column(len(keys)).to_pylist(), lead):
                if group != at:
                    more = parse_sheet(held, coded)
                    groups += [at] * len(more)
                    found += more
                    at, held, coded = group, [], bool(code)
                    if len(found) > 5_000:
                        yield told(key_types, groups, found)
                        groups, found = [], []
                held.append(cells or [])
        if at is not None:
            more = parse_sheet(held, coded)
            yield told(key_types, groups + [at] * len(more), found + more)

    # a number of tasks: by bytes, much work would go to few
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    rows = rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "row_no").select(*keys, "cells", *([leading] if leading else []))
    return rows.mapInArrow(run, ", ".join([*(f"{k} {types[k]}" for k in keys), *parsed]))


def parse_tables(grid: DataFrame) -> DataFrame:
    """Holdings of every sheet; a sheet (20,000 rows at most) is one group."""
    return parsed_groups(grid, ["file", "sheet"])
