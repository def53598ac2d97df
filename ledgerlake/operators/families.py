"""Workbooks to books: every house's files through the driver of its family, from bytes to holdings in one call.

A house names its family and switches in a table (``HOUSE``); a family is data (``FAMILIES``): where the title and the
short code stand, whether codes stand before names, which sheets count, whether a sheet holds one scheme or many.
What is decided on sheets and files is decided in DataFrame operations; only cells are read, and tables parsed, in
Python, a file or a sheet at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions import dates
from ..rules import first_by, has, ordered_case
from ..sources import paths, workbook
from ..sources.stages import staged
from . import sheets

HOUSE = "house string, family string, leading_code boolean, multi_sheet boolean, skip_mega boolean"

# Files, sheets and rows that are no scheme's, marks of a scheme inside a sheet, and labels of titles
SKIP_FILE = r"top\s*\d+\s*holdings(?:\s+by\s+issuer)?|holdings\s+by\s+issuer|issuer[-_\s]+sector[-_\s]+and[-_\s]+top[-_\s]+holdings|portfolio[-_\s]?disclosure[-_\s]?issuer"
MEGA_FILE = r"all[-_\s]?schemes|consolidated|combined[-_\s]?portfolio|debt-schemes-fortnightly-portfolio---as-on"
SKIP_MEMBER = r"risk-?o-?meter|fut\s*disclo|divmast|derivative"
JUNK_SHEET = r"^(?:index|contents|cover|notes?|disclaimer|summary|risk.?o.?meter|annexure|instruction|read.?me|legend|glossary|overview|derivatives?|top\s*\d+\s*(?:stocks?|securities|sectors?|groups?))$"
JUNK_PART = r"risk.?o.?meter|disclaimer|notes?\s*to|important\s+information|sebi\s+circular|exposure\s+to\s+top\s+\d+|top\s+\d+\s+(?:stocks?|securities|sectors?|groups?)"
FRONT_SHEET = r"^(?:index|contents|cover|notes)$"
GENERIC_TAB = r"^(?:sheet|index|contents|cover|notes)$"
SCHEME_MARK = r"(?i)^\s*SCHEME\s*:\s*(.+?)\s*$"
CODE_MARK = r"SCHEME\s*CODE\s*\d+\s*STARTS"
ANNEX = r"default\s+beyond\s+maturity|non[\s\-]?traded\s+securit|exposure\s+to\s+credit\s+default|total\s+amt\.?\s*due|value\s+as\s+per\s+nca|name\s+of\s+the\s+security\b|details\s+of\s+default|a1\)\s*exposure"
TABLE_HEAD = r"name\s+of\s+the\s+instrument|% to nav"
SCHEME_LABEL = r"scheme\s*name"


@dataclass(frozen=True)
class Family:
    """title: of the cells, or told by a label. code: of tab or cells (ticker), the tab, the tab or the file's first word (stem), or none. leading: codes before names (null: as the house says). sheets: which tabs don't count. marks: schemes inside a sheet."""

    title: str = "cells"
    code: str = "ticker"
    leading: bool | None = None
    sheets: str = "all"
    marks: bool = False


FAMILIES = {
    "sebi_title": Family(sheets="junk"),
    "cams": Family(title="label", code="stem", leading=True, sheets="junk"),
    "cams_sheet": Family(title="label", code="stem", leading=True, sheets="front"),
    "tab": Family(code="tab", leading=False),
    "tab_coded": Family(code="tab", leading=True, sheets="front"),
    "untabbed": Family(code="none", leading=False),
    "uti_mega": Family(code="none", leading=False, marks=True),
}


class Parsed(NamedTuple):
    """books: one row a scheme with its holdings' count; holdings: keyed by file, sheet_no, block; rejected: path, reason; grid: the cached cells (unpersist when done)."""

    books: DataFrame
    holdings: DataFrame
    rejected: DataFrame
    grid: DataFrame


def _of_family(attribute: str) -> Column:
    return ordered_case([(F.col("family") == k, getattr(f, attribute)) for k, f in FAMILIES.items() if getattr(f, attribute) is not None])


def _base(c: Column) -> Column:
    """A path's last part; of an archive's member, its name."""
    return F.regexp_extract(c, r"([^/!]+)$", 1)


def routed(files: DataFrame, houses: DataFrame) -> DataFrame:
    """Files with their house's family and switches, and the reason why a file has no driver (null: it has one)."""
    house = F.nullif(F.regexp_extract("path", r"/([^/]+)/(?:monthly|fortnightly)/", 1), F.lit(""))
    known = houses.select("house", "family", "leading_code", "multi_sheet", "skip_mega")
    f = files.withColumn("house", house).join(F.broadcast(known) if _small(known) else known, "house", "left")
    reason = ordered_case(
        [
            (F.col("house").isNull(), "no house in its path"),
            (F.col("family").isNull(), "no driver for its house"),
            (~F.col("family").isin(*FAMILIES), "its house's family is unknown"),
            (has(_base(F.col("path")), SKIP_FILE), "a marketing pack"),
        ]
    )
    return f.withColumn("reason", reason)


def _small(houses: DataFrame, most: int = 10_000) -> bool:
    """A registry of houses is small, yet counted before it is broadcast."""
    return houses.limit(most + 1).count() <= most


LABEL_ROWS = 25


def row_label(cells: Column) -> Column:
    """What a row's "scheme name" label tells, in the next filled cell or after a colon."""
    cells = F.filter(cells, lambda c: F.length(c) > 0)

    def after(pattern: str, not_pattern: str) -> Column:
        at = F.array_position(F.transform(cells, lambda c: has(F.trim(c), pattern)), True).cast("int")
        return F.when(at > 0, F.trim(F.try_element_at(F.filter(F.slice(cells, F.greatest(at, F.lit(0)) + 1, F.size(cells)), lambda c: ~has(c, not_pattern)), F.lit(1))))

    joined = F.array_join(cells, " | ")
    colon = F.nullif(F.trim(F.split(F.regexp_extract(joined, rf"(?i){SCHEME_LABEL}\s*:\s*(.+)$", 1), r"\|")[0]), F.lit(""))
    one = F.when(has(joined, rf"{SCHEME_LABEL}\s*:"), F.coalesce(after(SCHEME_LABEL, SCHEME_LABEL), colon))
    return F.coalesce(one, after(r"^name\s+of\s+the\s+scheme$", r"^name\s+of"))


def _sheet_facts(cells: DataFrame) -> DataFrame:
    """A row for each sheet: its first cells, title, label and day, all out of its first rows."""
    n = F.col("row_no")
    rows = cells.where(n < max(sheets.AS_OF_ROWS, LABEL_ROWS, sheets.TITLE_ROWS)).withColumn("joined", sheets.joined_cells(F.col("cells")))
    rows = rows.withColumn("t", F.when(n < sheets.TITLE_ROWS, sheets.row_title(F.col("cells")))).withColumn("l", F.when((n < LABEL_ROWS) & has("joined", "scheme"), row_label(F.col("cells"))))
    rows = rows.withColumn("d", F.when((n < sheets.AS_OF_ROWS) & has("joined", sheets.WEAK_LABEL), sheets.row_as_of(F.col("cells"))))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), n))
    facts = rows.groupBy("file", "sheet_no", "sheet", "size").agg(F.min_by("cells", n).alias("first"), first("t").alias("title"), first("l").alias("label_title"), sheets.first_as_of("d", "joined", "row_no").alias("sheet_day"))
    cell = lambda i: F.coalesce(F.try_element_at("first", F.lit(i)), F.lit(""))
    return facts.withColumn("a1", cell(1)).withColumn("b1", cell(2)).drop("first")


def _marked(grid: DataFrame) -> DataFrame:
    """Rows of sheets with scheme marks, by block: a mark opens one, a code mark closes it, annexes are cut off; a sheet without marks is one block."""
    label = F.try_element_at(F.filter(F.transform("cells", lambda c: F.regexp_extract(c, SCHEME_MARK, 1)), lambda x: F.length(x) > 0), F.lit(1))
    joined = F.array_join(F.filter("cells", lambda c: F.length(c) > 0), " | ")
    g = grid.withColumn("mark", label).withColumn("joined", joined)
    opens = F.col("mark").isNotNull() | has(F.col("joined"), CODE_MARK)
    g = sheets.blocks(g, ["file", "sheet_no"], "row_no", opens, "block")
    w = Window.partitionBy("file", "sheet_no")
    g = g.withColumn("any_mark", F.max(F.col("mark").isNotNull()).over(w))
    of = Window.partitionBy("file", "sheet_no", "block")
    name = F.first("mark", ignorenulls=True).over(of.orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    g = g.withColumn("mark_title", F.when(F.col("any_mark"), name).otherwise("Portfolio")).withColumn("block", F.when(F.col("any_mark"), F.col("block")).otherwise(0))
    g = g.where("mark_title is not null")
    head = F.min(F.when(has(F.col("joined"), TABLE_HEAD), F.col("row_no"))).over(of)
    g = g.withColumn("head", head)
    stop = (F.col("row_no") >= F.col("head")) & has(F.col("joined"), ANNEX) & ~has(F.col("joined"), TABLE_HEAD)
    g = sheets.trim_after(g, ["file", "sheet_no", "block"], "row_no", F.coalesce(stop, F.lit(False))).drop("mark", "joined", "any_mark", "head")
    return g.withColumn("row_no", F.col("row_no") - F.min("row_no").over(of))


def _counted_sheets(tabs: DataFrame) -> DataFrame:
    """Sheets that count by their family's rule; an only sheet called index does."""
    tab, w = F.trim(F.coalesce(F.col("sheet"), F.lit(""))), Window.partitionBy("file")
    junk = (tab == "") | has(tab, JUNK_SHEET) | (has(tab, JUNK_PART) & ~has(tab, r"portfolio|holding|isin"))
    skip = ordered_case([(F.col("which") == "junk", junk), (F.col("which") == "front", has(tab, FRONT_SHEET))], F.lit(False))
    t = tabs.withColumn("which", _of_family("sheets")).withColumn("skip", skip).withColumn("n_sheets", F.count("*").over(w))
    return t.where(~F.col("skip") | ((F.col("n_sheets") == 1) & has(tab, "^index$"))).withColumn("n_kept", F.count("*").over(w)).drop("which", "skip", "n_sheets")


def _counted_workbooks(tabs: DataFrame) -> DataFrame:
    """Workbooks that count: members of other kinds, marketing packs and, beside others, consolidated packs don't."""
    base, w = _base(F.col("file")), Window.partitionBy("path")
    t = tabs.where(~has(base, SKIP_FILE) & ~(_of_family("marks") & has(base, SKIP_MEMBER)))
    mega = has(base, MEGA_FILE) & F.coalesce("skip_mega", F.lit(True))
    t = t.withColumn("mega", mega).withColumn("other", F.max(~F.col("mega")).over(w))
    return t.where(~F.col("mega") | ~F.col("other")).drop("mega", "other")


def _named(b: DataFrame) -> DataFrame:
    """The scheme's name: as the family tells, else the tab; a bare code gives way to the file's own name."""
    stem = F.regexp_replace(_base(F.col("file")), r"\.\w+$", "")
    month = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
    said = F.regexp_replace(F.regexp_replace(stem, r"(?i)^(?:monthly|fortnightly)\s+", ""), rf"(?i)\s*[-_ ]+\d{{1,2}}(?:st|nd|rd|th)?\s+{month}\s+\d{{4}}\s*$", "")
    said = F.regexp_replace(said, r"^[ \-_]+|[ \-_]+$", "")
    tab = F.nullif(F.trim("sheet"), F.lit(""))
    cells = F.coalesce(F.col("title"), tab, F.lit("unknown"))
    label = F.coalesce(F.col("label_title"), cells)
    label = F.when(has(label, r"^name\s+of\s+the\s"), F.coalesce("title", stem)).otherwise(label)
    rule = _of_family("title")
    name = F.coalesce("mark_title", F.when(rule == "label", label).otherwise(cells))
    generic = F.coalesce(has(tab, GENERIC_TAB), F.lit(True))
    by_stem = F.when(~generic, tab).otherwise(F.nullif(F.regexp_extract(F.upper(stem), r"^([A-Z0-9]+)", 1), F.lit("")))
    code_rule = _of_family("code")
    code = ordered_case([(code_rule == "ticker", sheets.sheet_shortcode(F.coalesce(F.col("sheet"), F.lit("")), F.col("a1"), F.col("b1"))), (code_rule == "tab", tab), (code_rule == "stem", by_stem)])
    b = b.withColumn("shortcode", code).withColumn("scheme", name)
    bare = (F.upper("scheme") == F.upper(F.coalesce("shortcode", F.lit("")))) | F.col("scheme").rlike("^[A-Z0-9]{3,12}$")
    whole = F.col("family").isin("sebi_title", "cams")
    return b.withColumn("scheme", F.when(whole & bare & (F.length(said) > 8), said).otherwise(F.col("scheme")))


def rejected(files: DataFrame, houses: DataFrame) -> DataFrame:
    """(path, reason) of the files that no driver takes or that can't be read: every file is worked out once, read where it has a driver, and no cell is kept."""
    return routed(files, houses).select("path", "content", "reason").mapInArrow(workbook.problems, "path string, reason string")


def parse(files: DataFrame, houses: DataFrame) -> Parsed:
    """Books and holdings of all files (path, content) by their houses' drivers.

    A file that can't be read or has no driver is told in ``rejected``; sheets without holdings are dropped where a
    workbook has others; of the books of one file with one short code the richest stays, the first on a tie (files by
    size, then sheets in order). A null house, family or content is a reason; an empty table gives empty results.

    Cells are read once and kept; holdings are staged. What is rejected is worked out on its own, without cells.
    """
    f = routed(files, houses)
    grid = workbook.grids(f.where("reason is null and content is not null")).persist(StorageLevel.MEMORY_AND_DISK)
    cells = grid.where("error is null").drop("error")

    keys, unit = ["file", "sheet_no"], ["file", "sheet_no", "block"]
    # a path tells its house, so files aren't worked out again
    tabs = routed(_sheet_facts(cells).withColumn("path", F.split_part("file", F.lit("!"), F.lit(1))), houses).drop("reason")
    tabs = staged(_counted_sheets(_counted_workbooks(tabs)).withColumn("leading", F.coalesce(_of_family("leading"), F.col("leading_code"), F.lit(False))).withColumn("marks", _of_family("marks")))

    kept = cells.select(*keys, "row_no", "cells").join(tabs.select(*keys, "leading", "marks"), keys)
    marked = _marked(kept.where("marks"))
    columns = [*unit, "row_no", "cells", "leading"]
    holdings = staged(sheets.parsed_groups(kept.where("not marks").withColumn("block", F.lit(0)).select(columns).unionByName(marked.select(columns)), unit, "leading"))

    counts = holdings.groupBy(*unit).agg(F.count("*").alias("n_holdings"))
    days = marked.where(F.col("row_no") < sheets.AS_OF_ROWS).withColumn("joined", sheets.joined_cells(F.col("cells"))).withColumn("d", F.when(has("joined", sheets.WEAK_LABEL), sheets.row_as_of(F.col("cells"))))
    blocks = days.groupBy(*unit).agg(F.first("mark_title").alias("mark_title"), sheets.first_as_of("d", "joined", "row_no").alias("block_day"))
    whole = tabs.where("not marks").select(*keys, F.lit(0).alias("block"), F.lit(None).cast("string").alias("mark_title"), F.col("sheet_day").alias("block_day"))
    b = whole.unionByName(blocks).join(tabs, keys).join(counts, unit, "left").na.fill(0, ["n_holdings"])
    b = _named(b.where((F.col("n_holdings") > 0) | (~F.col("marks") & ((F.col("n_kept") == 1) | ~F.col("family").isin("sebi_title", "cams")))))
    b = b.withColumn("path_name", _base(F.col("path"))).withColumn("file_name", _base(F.col("file")))
    b = b.withColumn("path_day", dates.parse_as_of(F.col("path_name"))).withColumn("file_day", dates.parse_as_of(F.col("file_name")))
    day = lambda told, name: dates.choose_as_of(F.col(told), F.col(f"{name}_day"), F.col(f"{name}_name"))
    b = b.withColumn("as_of", F.coalesce(day("block_day", "path"), day("sheet_day", "file")))
    order = Window.partitionBy("file").orderBy("sheet_no", "block")
    b = b.withColumn("nth", F.row_number().over(order)).where(F.coalesce("multi_sheet", F.lit(True)) | (F.col("nth") == 1) | F.col("marks"))
    code = F.upper(F.trim("shortcode"))
    deduped = first_by(b.where(code.isNotNull() & (code != "") & F.col("family").isin("sebi_title", "cams")).withColumn("__code", code), ["path", "__code"], [F.col("n_holdings").desc(), F.col("size"), F.col("file"), F.col("sheet_no"), F.col("block")]).drop("__code")
    rest = b.where(~F.coalesce(code != "", F.lit(False)) | ~F.col("family").isin("sebi_title", "cams"))
    out = deduped.unionByName(rest.select(deduped.columns))
    books = out.select("house", "family", F.coalesce(paths.cadence_of(F.col("path")), F.lit("monthly")).alias("cadence"), paths.period_of(F.col("path")).alias("period"), "file", "sheet_no", "sheet", "block", "scheme", "shortcode", "as_of", F.col("n_holdings"))
    return Parsed(books, holdings, rejected(files, houses), grid)
