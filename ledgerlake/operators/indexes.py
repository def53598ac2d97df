"""Index tables and loose sheets: code and name pairs of contents sheets, rows owned by the scheme that a column names.

A grid has columns file, sheet, row_no, cells; row order is data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headers

# Headers of codes, short names and names in contents sheets, in order of preference, and cells that only repeat a header
CODE_HEADS = ("fund code", "scheme code", "fund id", "scheme id", "code")
SHORT_HEADS = ("scheme short code", "short name", "short code", "fund short name")
NAME_HEADS = ("scheme name", "scheme names", "fund name", "scheme full name", "fund desc", "fund description", "name of the scheme", "name of scheme")
NOT_CODES = ("scheme code", "fund code", "code", "classification", "fund id", "short name")
NOT_NAMES = ("scheme name", "fund name", "click", "fund desc", "fund description")
BLANKS = ("", "-", "--", "total", "totals", "grand total", "sub total", "subtotal")
INDEX_ROWS, HEAD_ROWS = 40, 60
ISIN = r"[A-Z]{2}[A-Z0-9]{9}[0-9]$"


def _place(cells: Column, heads: tuple[str, ...]) -> Column:
    """The place (from 1) of the first of some headers that a row holds, in their order."""
    low = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    return F.coalesce(*[F.nullif(F.array_position(low, h), F.lit(0)) for h in heads]).cast("int")


def index_pairs(grid: DataFrame) -> DataFrame:
    """file, sheet, row_no, code, name of index tables.

    Columns are known once a row so far has told a code's (or a short name's) and a name's header, the latest counting;
    a short code stands for a code of digits alone. Rows without either, and those that repeat headers, are left out.
    """
    keys = ["file", "sheet"]
    so_far = Window.partitionBy(*keys).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    top = grid.where(F.col("row_no") < INDEX_ROWS)
    for name, heads in (("code_at", CODE_HEADS), ("short_at", SHORT_HEADS), ("name_at", NAME_HEADS)):
        top = top.withColumn(name, F.last(_place(F.col("cells"), heads), ignorenulls=True).over(so_far))
    top = top.withColumn("code_at", F.coalesce("code_at", F.when(F.col("name_at").isNotNull(), F.col("short_at"))))
    known = F.col("code_at").isNotNull() & F.col("name_at").isNotNull()
    head = top.where(known).groupBy(*keys).agg(F.min_by(F.struct("row_no", "code_at", "short_at", "name_at"), "row_no").alias("head"))
    rows = grid.join(head, keys).where(F.col("row_no") > F.col("head.row_no"))
    cell = lambda at: F.trim(F.coalesce(F.try_element_at("cells", F.col(f"head.{at}")), F.lit("")))
    rows = rows.withColumn("code", cell("code_at")).withColumn("name", F.trim(F.regexp_replace(cell("name_at"), r"\s+", " ")))
    short = F.when(F.col("head.short_at").isNotNull(), F.nullif(cell("short_at"), F.lit("")))
    rows = rows.withColumn("short", F.coalesce(short, F.col("code")))
    rows = rows.where((F.col("code") != "") & (F.col("name") != "") & ~F.lower("code").isin(*NOT_CODES) & ~F.lower("name").isin(*NOT_NAMES))
    code = F.when(F.col("code").rlike(r"^\d{2,6}$") & (F.col("short") != F.col("code")), F.col("short")).otherwise(F.col("code"))
    return rows.select(*keys, "row_no", code.alias("code"), "name")


def scheme_rows(grid: DataFrame, multi_sheet: bool = True) -> DataFrame:
    """file, sheet, row_no, scheme, fields (header name to cell) of the holdings of sheets without a scheme's own layout.

    The header is the first of the first rows with two hints. A row's scheme is what its scheme column says, else (no
    such column, several sheets) the sheet, else the file. Rows that are empty, totals, of one cell, or of two without
    a holding's mark are left out; sheets without a header have none.
    """
    keys = ["file", "sheet"]
    hinted = grid.where((F.col("row_no") < HEAD_ROWS) & (headers.row_hints(F.col("cells")) >= 2))
    head = hinted.groupBy(*keys).agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("h"))
    said = F.transform("h.cells", lambda c, i: F.when(F.coalesce(c, F.lit("")) == "", F.concat(F.lit("col_"), (i + 1).cast("string"))).otherwise(c))
    head = head.select(*keys, F.col("h.row_no").alias("head_row"), said.alias("said"))
    head = head.select(*keys, "head_row", headers.legacy_names(F.col("said")).alias("names"), headers.scheme_column(F.col("said")).alias("scheme_at"))
    rows = grid.join(head, keys).where(F.col("row_no") > F.col("head_row"))
    low = F.transform("cells", lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    rows = rows.withColumn("low", low).withColumn("filled", F.filter("low", lambda c: c != ""))
    total = F.exists(F.slice("low", 1, 3), lambda c: F.startswith(c, F.lit("total"))) & (F.size("filled") <= 3)
    rows = rows.where((F.size("filled") > 0) & ~F.forall("low", lambda c: c.isin(*BLANKS)) & ~total)
    cell = lambda i: F.coalesce(F.try_element_at("cells", i), F.lit(""))
    fields = F.map_from_arrays("names", F.transform("names", lambda _, i: cell(i + 1)))
    rows = rows.withColumn("fields", fields).withColumn("n", F.size(F.filter(F.map_values("fields"), lambda v: F.trim(v) != "")))
    marks = [F.coalesce(F.try_element_at("fields", F.lit(k)), F.lit("")) != "" for k in ("isin", "quantity", "market_value", "pct_nav")]
    signal = marks[0] | marks[1] | marks[2] | marks[3] | F.exists(F.map_values("fields"), lambda v: v.rlike(f"^{ISIN}"))
    rows = rows.where((F.col("n") > 1) & (signal | (F.col("n") >= 3)))
    stem = F.regexp_replace(F.regexp_extract("file", r"([^/!]+)$", 1), r"\.\w+$", "")
    default = F.when(F.col("scheme_at").isNull() & F.lit(multi_sheet), F.col("sheet")).otherwise(stem)
    own = F.when(F.col("scheme_at").isNotNull(), F.nullif(F.trim(cell(F.col("scheme_at"))), F.lit("")))
    return rows.select(*keys, "row_no", headers.scheme_folder(F.coalesce(own, default)).alias("scheme"), "fields")
