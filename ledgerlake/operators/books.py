"""Order-aware transforms of holdings, each within one book.

A book's rows share ``book``; ``ordinal`` is their order. All windows partition by ``book`` alone, so a chain of
these steps costs one exchange. Sums are taken in DECIMAL, for results that don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"


def _over(book: str):
    return Window.partitionBy(book)


def _total(c: Column, book: str) -> Column:
    return F.sum(c.cast(EXACT)).over(_over(book)).cast("double")


# Four detectors of weights given as fractions. They differ on purpose and are never merged.


def parser_fraction(w: Column, book: str) -> Column:
    """Largest at most 1.5, and the total or the positive total within 10 % of 1."""
    top, total, plus = F.max(F.abs(w)).over(_over(book)), _total(w, book), _total(F.when(w >= 0, w), book)
    return F.coalesce((top <= 1.5) & (F.abs(total).between(0.90, 1.10) | plus.between(0.90, 1.10)), F.lit(False))


def contract_fraction(w: Column, book: str) -> Column:
    """Largest at most 1.5, and the total within 15 % of 1."""
    top, total = F.max(F.abs(w)).over(_over(book)), _total(w, book)
    return F.coalesce((top <= 1.5) & F.abs(total).between(0.85, 1.15), F.lit(False))


def qc_fraction(w: Column, book: str, largest: float = 1.5) -> Column:
    """Largest at most 1.5 (1.0 for the top-5 check), whatever the total."""
    return F.coalesce(F.max(F.abs(w)).over(_over(book)) <= largest, F.lit(False))


def allocation_fraction(top: Column, totals: list[Column]) -> Column:
    """One decision for all of a book's totals."""
    near = F.lit(False)
    for t in totals:
        near = near | F.abs(t).between(0.90, 1.10)
    return F.coalesce((top <= 1.5) & near, F.lit(False))


def to_percent(df: DataFrame, book: str, weight: str, detector=parser_fraction) -> DataFrame:
    return df.withColumn("__f", detector(F.col(weight), book)).withColumn(weight, F.when(F.col("__f"), F.col(weight) * 100).otherwise(F.col(weight))).drop("__f")


def value_scale(df: DataFrame, book: str, value: str) -> DataFrame:
    """Absolute rupees (largest value from 1e8) become lakhs."""
    big = F.max(F.abs(F.col(value))).over(_over(book)) >= 1e8
    return df.withColumn("__b", big).withColumn(value, F.when(F.col("__b"), F.col(value) * 1e-5).otherwise(F.col(value))).drop("__b")


def ratio_to_total(df: DataFrame, book: str, value: str, out: str, only_missing: str | None = None) -> DataFrame:
    """100 * value / the book's total; with ``only_missing``, only where that weight is null or zero."""
    share = F.try_divide(F.col(value) * 100, _total(F.col(value), book))
    if only_missing:
        share = F.when(F.coalesce(F.col(only_missing), F.lit(0.0)) == 0, share).otherwise(F.col(only_missing))
    return df.withColumn(out, share)


def collapse_adjacent(df: DataFrame, book: str, ordinal: str, flag: Column) -> DataFrame:
    """Of neighbouring flagged rows only the last stays."""
    df = df.withColumn("__x", F.coalesce(flag, F.lit(False)))
    follows = F.lead("__x", 1, False).over(Window.partitionBy(book).orderBy(ordinal))
    return df.withColumn("__y", follows).where(~(F.col("__x") & F.col("__y"))).drop("__x", "__y")


def drop_when_present(df: DataFrame, book: str, drop: Column, present: Column) -> DataFrame:
    """Rows of one kind go in books that hold a row of the other."""
    df = df.withColumn("__p", F.max(F.coalesce(present, F.lit(False))).over(_over(book)))
    return df.where(~(F.coalesce(drop, F.lit(False)) & F.col("__p"))).drop("__p")


def drop_rollup(df: DataFrame, book: str, weight: str, rollup: Column, kind: Column, required: str, tolerance: float) -> DataFrame:
    """A roll-up row goes where it equals the sum of its children: two kinds or more, the required one among them."""
    child = F.when(~F.coalesce(rollup, F.lit(False)), kind)
    df = df.withColumn("__r", F.coalesce(rollup, F.lit(False))).withColumn("__k", child)
    df = df.withColumn("__s", _total(F.when(F.col("__k").isNotNull(), F.col(weight)), book)).withColumn("__n", F.collect_set("__k").over(_over(book)))
    gone = F.col("__r") & (F.size("__n") >= 2) & F.array_contains("__n", required) & (F.abs(F.col(weight) - F.col("__s")) <= tolerance)
    return df.where(~F.coalesce(gone, F.lit(False))).drop("__r", "__k", "__s", "__n")


def junk_weights(df: DataFrame, book: str, value: str, quantity: str, weight: str) -> DataFrame:
    """Books without any positive value: values from quantities (0.01 each), weights anew."""
    df = df.withColumn("__z", ~F.coalesce(F.max(F.col(value) > 0).over(_over(book)), F.lit(False)) & F.coalesce(F.max(F.abs(F.col(quantity)) > 0).over(_over(book)), F.lit(False)))
    df = df.withColumn(value, F.when(F.col("__z"), 0.01 * F.abs(F.col(quantity))).otherwise(F.col(value)))
    fresh = F.try_divide(F.col(value) * 100, _total(F.col(value), book))
    return df.withColumn(weight, F.when(F.col("__z"), fresh).otherwise(F.col(weight))).drop("__z")


def rebase_from_value(df: DataFrame, book: str, value: str, weight: str, stated: str, tolerance: float = 5e-4) -> DataFrame:
    """Weights from value / stated total where the weights don't sum to 100 but the values reconcile with it."""
    broken = ~F.coalesce(F.abs(_total(F.col(weight), book) - 100) <= 0.1, F.lit(False))
    full = F.min(F.col(value).isNotNull()).over(_over(book))
    agrees = F.abs(_total(F.col(value), book) / F.col(stated) - 1) <= tolerance
    df = df.withColumn("__b", broken & full & F.coalesce(agrees, F.lit(False)))
    return df.withColumn(weight, F.when(F.col("__b"), F.col(value) * 100 / F.col(stated)).otherwise(F.col(weight))).drop("__b")


def absorb_residual(df: DataFrame, book: str, ordinal: str, weight: str, cash: Column, low: float = 99.50, high: float = 99.95) -> DataFrame:
    """A small shortfall goes to the last cash row."""
    df = df.withColumn("__t", _total(F.col(weight), book)).withColumn("__c", F.coalesce(cash, F.lit(False)))
    last = F.max(F.when(F.col("__c"), F.col(ordinal))).over(_over(book))
    here = F.col("__c") & (F.col(ordinal) == F.col("__l")) & (F.col("__t") >= low) & (F.col("__t") < high)
    return df.withColumn("__l", last).withColumn(weight, F.when(here, F.col(weight) + 100 - F.col("__t")).otherwise(F.col(weight))).drop("__t", "__c", "__l")


def allocation_totals(df: DataFrame, book: str, weight: str, future: Column, option: Column) -> DataFrame:
    """Per book: all, without futures, without options, without either; one scale for the four."""
    w = F.col(weight).cast(EXACT)
    total = lambda c: F.sum(F.when(c, w)).cast("double")
    f, o = F.coalesce(future, F.lit(False)), F.coalesce(option, F.lit(False))
    out = df.groupBy(book).agg(total(F.lit(True)).alias("t_all"), total(~f).alias("t_no_futures"), total(~o).alias("t_no_options"), total(~f & ~o).alias("t_plain"), F.max(F.abs(F.col(weight))).alias("top"))
    names = ("t_all", "t_no_futures", "t_no_options", "t_plain")
    out = out.withColumn("scaled", allocation_fraction(F.col("top"), [F.col(n) for n in names]))
    return out.select(book, "scaled", *[F.when(F.col("scaled"), F.col(n) * 100).otherwise(F.col(n)).alias(n) for n in names])


def meets_allocation(*totals: Column, tolerance: float = 0.10) -> Column:
    ok = F.lit(False)
    for t in totals:
        ok = ok | F.coalesce(F.abs(t - 100) <= tolerance, F.lit(False))
    return ok


def normalize(df: DataFrame, book: str = "book", ordinal: str = "ordinal") -> DataFrame:
    """The post-parse steps in their fixed order, over columns instrument, section, isin, quantity, market_value, pct_nav, stated_total."""
    from ..functions.classify import is_cash
    from ..rules import has

    receivables, assets = r"net\s+receivables?", r"net\s+current\s+assets?|\bnca\b"
    cash = is_cash(F.col("instrument"), F.col("section"), F.col("isin"))
    kind = F.when(has("instrument", receivables), "receivables").when(has("instrument", r"reverse\s+repos?|treps?"), "repo").when(cash, "cash")
    df = collapse_adjacent(df, book, ordinal, has("instrument", receivables))
    df = drop_when_present(df, book, has("instrument", r"\bccil\b.*margin|exchange\s+margin"), has("instrument", assets))
    df = drop_rollup(df, book, "pct_nav", has("instrument", assets), kind, "receivables", 0.05)
    df = junk_weights(df, book, "market_value", "quantity", "pct_nav")
    df = to_percent(df, book, "pct_nav", parser_fraction)
    df = rebase_from_value(df, book, "market_value", "pct_nav", "stated_total")
    df = absorb_residual(df, book, ordinal, "pct_nav", cash)
    return df.withColumn("instrument", F.when(cash, F.lit("Cash")).otherwise(F.col("instrument")))


def publish(df: DataFrame, book: str = "book") -> DataFrame:
    """Raw holdings as the 17 contract fields, typed, scaled and classified, plus the book."""
    from ..functions.classify import holding_type, industry_and_rating
    from ..functions.numbers import parse_number, round6
    from ..functions.text import text_or_null
    from ..schemas import HOLDING

    df = df.withColumn("__type", holding_type(F.col("instrument"), F.col("section"), F.concat_ws(" ", "industry", "industry_rating"), F.col("isin")))
    df = df.withColumn("__ir", industry_and_rating(*[text_or_null(F.col(c)) for c in ("industry", "industry_rating", "rating")]))
    for c in ("coupon", "quantity", "market_value", "pct_nav", "ytm", "ytc", "instrument_yield"):
        df = df.withColumn(c, parse_number(F.col(c)))
    df = value_scale(df, book, "market_value")
    df = to_percent(df, book, "pct_nav", contract_fraction)
    df = ratio_to_total(df, book, "market_value", "pct_nav", only_missing="pct_nav")

    def field(f):
        if f.name == "instrument":
            return F.coalesce(F.trim("instrument"), F.lit(""))
        if f.name == "holding_type":
            return F.col("__type")
        if f.name in ("industry", "rating"):
            return F.col(f"__ir.{f.name}")
        if f.dataType.typeName() == "double":
            return round6(F.col(f.name))
        return text_or_null(F.col(f.name)) if f.name in df.columns else F.lit(None).cast("string")

    return df.select(book, *[field(f).cast(f.dataType).alias(f.name) for f in HOLDING])
