"""Number coercion and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import EMPTY_TOKENS

_SHAPE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def plain_number(c: Column) -> Column:
    """A number in full, else null; text such as ``1d`` or ``nan`` is no number."""
    t = F.trim(c)
    return F.when(t.rlike(_SHAPE), t).try_cast("double")


def parse_number(c: Column) -> Column:
    """Currency, percent and thousands marks go; otherwise the first number inside the text; empty tokens are null."""
    t = F.trim(c)
    t = F.when(~F.lower(t).isin(*EMPTY_TOKENS), F.trim(F.regexp_replace(t, r"(?i)rs\.?|inr|[%$,₹]", "")))
    inside = F.nullif(F.regexp_extract(t, r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?", 0), F.lit(""))
    return F.coalesce(plain_number(t), inside.try_cast("double"))


def parser_number(c: Column) -> Column:
    """The sheet parser's form: only thousands and percent marks go."""
    return plain_number(F.regexp_replace(c, "[,%]", ""))


def check_weight(c: Column) -> Column:
    """The quality check's weights: thousands and percent marks go, "NIL" is none."""
    return plain_number(F.regexp_replace(F.trim(c), "[,%]", ""))


def shown6(x: Column) -> Column:
    """Six decimal places, zeros at the end left out."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x.cast("double")), r"0+$", ""), r"\.$", "")


def round6(c: Column) -> Column:
    """Half-even at 6 decimal places, in decimal arithmetic."""
    return F.bround(c.cast("decimal(38,12)"), 6).cast("double")


def within_tolerance(a: Column, b: Column, absolute: float = 0.35, relative: float = 0.15) -> Column:
    gap = F.abs(a - b)
    return (gap <= absolute) | (gap / F.greatest(F.abs(a), F.lit(0.2)) <= relative)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half up; null for an empty whole."""
    return F.round(F.try_divide((part * 100).cast("decimal(20,0)"), whole.cast("decimal(20,0)")), digits).cast("double")
