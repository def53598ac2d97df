"""Text keys and cleaning, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for "no value"
EMPTY_TOKENS = ("", "-", "--", "—", "na", "n/a", "n.a.", "nil", "null", "none", ".", "nan", "^", "#", "@", "$", "% to nav", "% to n.a.v")

# Plan words at the end of a fund's name
PLAN_TAIL = r"(?i)[\s\-–(]*\b(?:direct|regular|growth|idcw|dividend|bonus|plan|option|payout|reinvestment)\b[\s)]*$"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def norm_text(c: Column) -> Column:
    """Lower case, ``&`` as "and", other than letters and digits as single spaces."""
    c = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(c, r"[^a-z0-9]+", " "))


def compact(c: Column) -> Column:
    return F.replace(norm_text(c), F.lit(" "), F.lit(""))


def text_or_null(c: Column) -> Column:
    """The trimmed text, null for any of the empty tokens."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*EMPTY_TOKENS), t)


def clean_label(c: Column) -> Column:
    """Zero-width and no-break characters as spaces, squeezed."""
    return squeeze(F.regexp_replace(c, "[\\u200b-\\u200d\\ufeff\\u00a0]+", " "))


def strip_tags(c: Column) -> Column:
    """Markup removed, the five basic character references decoded."""
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return squeeze(c)


def escaped(c: Column) -> Column:
    """A text as markup shows it; null as an empty one."""
    c = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def strip_to_fixpoint(c: Column, pattern: str, rounds: int = 4) -> Column:
    """Remove a tail pattern again and again, a bounded number of times."""
    return reduce(lambda x, _: F.trim(F.regexp_replace(x, pattern, "")), range(rounds), c)


def base_name(c: Column) -> Column:
    """A fund's name without plan and option words at its end."""
    return squeeze(strip_to_fixpoint(c, PLAN_TAIL, 6))


def safe_name(c: Column, size: int = 180) -> Column:
    return F.substring(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9._-]+", "_"), 1, size)


def shortcode(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"[^A-Za-z0-9]", ""))


def collapse_header(c: Column) -> Column:
    return F.regexp_replace(squeeze(F.regexp_replace(c, r"(?i)_x000d_|[\r\n]+", " ")), r"^[\s:;,.\-]+|[\s:;,.\-]+$", "")


def invested_in(c: Column) -> Column:
    """The host named after "invested in", or null."""
    return F.nullif(F.trim(F.regexp_extract(c, r"(?i)\binvested\s+in\s+(.+?)\s*\)?$", 1)), F.lit(""))


def ordered_labels(*labels: Column) -> Column:
    """Distinct non-empty labels, first order kept."""
    return F.array_distinct(F.filter(F.array(*labels), lambda x: F.length(x) > 0))
