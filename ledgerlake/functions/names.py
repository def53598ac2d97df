"""Fund names: rewrites, peeled labels, file names and shape tests, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import once
from .text import norm_text, squeeze

# Spellings and renamings in the master's names, applied in this order
NAME_REWRITES = (
    ("glit", "gilt"), ("reality", "realty"), ("financials", "financial"), ("consumer trends", "consumption"), ("hybrd", "hybrid"), ("hyrbrid", "hybrid"),
    ("govenment", "government"), ("duratio ", "duration "), ("duratiofund", "durationfund"), ("owsal", "oswal"), ("midsmall ", "midsmallcap "), ("largecap", "large cap"), ("smallcap", "small cap"),
    ("multicap", "multi cap"), ("midcap", "mid cap"), ("flexicap", "flexi cap"), ("emerging market fund", "emerging markets fund"), ("fund of funds", "fund of fund"), ("fund of fund", "fof"),
    ("asia pacific yield", "asia pacific ex japan dividend yield"), ("dynamic term fund", "dynamic bond fund"), ("ultra short term fund", "ultra short duration fund"),
    ("omni fund of fund", "active fund of fund"), ("payouout", "payout"), ("interval fund interval fund", "interval fund"), ("bharat bond etf fof", "bharat bond fof"),
)
# Short labels of packs and what they stand for, applied in this order
ABBREVIATIONS = (
    (r"\bEdel\b", "Edelweiss"), (r"\bNY\b", "Nifty"), (r"\bLMcap", "LargeMidcap"), (r"\bG[\s\-]?S\b", "G-Sec"), (r"\bIDX\b", "Index Fund"), (r"\bPl\b", "Plus"), (r"\bWD\b", "World"), (r"\bDM\b", "Domestic"),
    (r"\bHC\b", "Healthcare"), (r"\bID\s+Fund\b", "Index Fund"), (r"\(\s*I\s*\)", "India"), (r"\bMMF\b", "Money Market Fund"), (r"\bLargeMidcap\s*250\b", "LargeMidcap250"), (r"\bfixed\s+term\s+plan\b", "Fixed Term"),
    (r"\bunit\s+linked\s+insurance\s+scheme\b", "ULIS"), (r"\bQlty\b", "Quality"), (r"\bquarterly\s+interval\s+fund\b", "Interval Fund"), (r"\bseries\s*[-–—]?\s*2\b", "Series II"), (r"\bseries\s*[-–—]?\s*ii\b", "Series II"),
    (r"\bfund\s+of\s+funds?\s*[-–—:]?\s*conservative\b", "FOF - C"), (r"\bfund\s+of\s+funds?\s*[-–—:]?\s*aggressive\b", "FOF - Aggressive"), (r"\bmulti\s*[- ]?\s*asset\s+allocation\s+fund\b", "Multi Asset Fund"),
    (r"\bsmallcap\s*250\b", "Smallcap 250"), (r"\bmomentum\s+quality\s*(?:100|index)?\b", "Momentum quality index"),
)
# Words that open a variant's tail
VARIANT_WORDS = ("unclaimed", "cumulative", "retail", "super institutional", "institutional", "defunct", "discontinued", "prescribed date", "segregated", "principal unit", "payout", "reinvest", "formerly", "erstwhile", "standard", "payment", "no lock in", "periodic", "provident")
CLOSED_END = r"fixed\s+(?:maturity|term)|\bfmp\b|interval\s+fund|capital\s+protection|series\s+[ivx\d]+\s*$"
# Words of debt funds
DEBT_WORDS = r"\b(?:liquid|overnight|money\s*market|ultra\s*short|low\s*duration|short\s*(?:term|duration|tem)|medium\s*(?:term|duration)|long\s*duration|dynamic\s*(?:bond|accrual)|corporate\s*bond|credit\s*risk|banking\s*(?:and|&)?\s*psu|gilt|g[\s-]?sec|floater|floating\s*rate|debt|income|bond|accrual|arbitrage|savings|segregated\s*portfolio|conservative\s*hybrid|equity\s*savings|fixed\s*(?:maturity|term)|fmp|target\s*maturity|crisil\s*ibx|nifty.*(?:sdl|gilt|bond)|retirement.*debt|children.*debt)\b"
JUNK = r"^\s*(?:index|sheet\d*|cover|contents?|disclaimer|notes?|summary|annex\w*|riskometer|hyperlinks?)\s*$"


def rewrite(c: Column, pairs) -> Column:
    """Plain replacements one after another."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def root_key(c: Column) -> Column:
    """A key without spaces in which renamed and misspelt names meet."""
    t = F.regexp_replace(rewrite(norm_text(c), NAME_REWRITES), r"\bmmf\b", "money market fund")
    t = F.replace(F.regexp_replace(squeeze(t), r"duratio$", "duration"), F.lit(" "), F.lit(""))
    return rewrite(t, (("duratio", "duration"), ("durationn", "duration"), ("midsmallcapcap", "midsmallcap"), ("intervalfundintervalfund", "intervalfund")))


def expand(c: Column) -> Column:
    """Short labels in full."""
    return squeeze(reduce(lambda x, p: F.regexp_replace(x, f"(?i){p[0]}", p[1]), ABBREVIATIONS, squeeze(c)))


def strip_variant(c: Column, rounds: int = 4) -> Column:
    """A variant's tail, from its opening word on, removed again and again."""
    words = "|".join(w.replace(" ", r"\s+") for w in VARIANT_WORDS)
    return reduce(lambda x, _: F.trim(F.regexp_replace(x, rf"(?i)\s*[-–(:]?\s*\b(?:{words})s?\b.*$", "")), range(rounds), c)


# What a label says before and after a scheme's name, and labels that name none; tails go in this order
STATEMENT_OF = r"(?i)^(?:monthly\s+|fortnightly\s+)?portfolio(?:\s+statement)?\s+of\s+(.+?)(?:\s+as\s+on\b.*)?$"
DATE_TAILS = (r"(?i)\s+as\s+on\s+\d{1,2}\s*[-/]\s*[A-Za-z]{3,9}\s*[-/]\s*\d{2,4}\s*$", r"(?i)\s+as\s+on\s+\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\s*$")
OPEN_ENDED = (r"(?i)\s*\(+[^)]*(?:open[-\s]?ended|close[-\s]?ended|exchange\s+traded)[^)]*\)+\s*$", r"(?i)\s*\(+[^)]*(?:open[-\s]?ended|close[-\s]?ended).*$")
DESCRIPTION_TAILS = (
    r"(?i)\s+(?:for\s+)?(?:january|february|march|april|may|june|july|august|september|october|november|december)\s+20\d{2}\s*$",
    r"(?i)\s*[-–—]\s*an?\s+open[-\s]?ended\b.*$", r"(?i)\s*[-–—]\s*a\s+relatively\b.*$", r"(?i)\s*\(?\s*(?:formerly|erstwhile)\s+know(?:n)?(?:\s+as)?\b.*$", r"(?i)\s*\(?\s*erstwhile\b.*$",
    r"(?i)^[A-Z]{1,4}\d{0,4}\s*[-–—:]\s*", r"\s*\([A-Z0-9][^)]*$", r"(?i)\s*\(\s*the\s+scheme\s+has\b.*$", *OPEN_ENDED, *OPEN_ENDED, *OPEN_ENDED,
    r"(?i)\s*\(\s*An?\s+[^)]{8,}\)\s*$", r"(?i)\s*\(\s*The\s+[^)]{8,}\)\s*$", r"(?i)\s*\(\s*\d{2,5}\s*days?\s*\)\s*$", r"(?i)\s*\(\s*A\s+\d+[^)]*\)\s*$", r"(?i)\s+\d{2,5}\s*days?\s*$",
)
NO_NAME = r"(?i)^name of mutual fund\s*:|^scheme\s*name\s*:?$"
MATURITY = r"(?i)\b((?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\s*-?\s*(?:19|20)\d{2})\b"
PLAN_TAILS = (r"(?i)\s*[-–—]?\s*(?:direct|regular)\b.*$", r"(?i)\s*[-–—]?\s*(?:growth|idcw|dividend|payout|reinvestment)\b.*$")


def cut(c: Column, tails) -> Column:
    """Tails removed one after another."""
    return reduce(lambda x, p: F.trim(F.regexp_replace(x, p, "")), tails, c)


def strip_description(c: Column) -> Column:
    """A scheme's name without what labels say around it: statements and dates, categories, former names, tickers, tenures; labels that name no scheme are empty."""

    def body(t: Column) -> Column:
        of = F.regexp_replace(F.regexp_extract(t, STATEMENT_OF, 1), r"^[ \-]+|[ \-]+$", "")
        name = cut(F.when(of != "", of).otherwise(cut(t, DATE_TAILS)), DESCRIPTION_TAILS)
        return F.when(name.rlike(NO_NAME), F.lit("")).otherwise(name)

    return once(squeeze(F.coalesce(c, F.lit(""))), body)


def match_key(base: Column, canonical: Column) -> Column:
    """The key by which a fund is matched: its base name without descriptions and variant tails.

    A month of maturity that only the canonical name tells is added; where that name, peeled of its plan, goes on
    beyond the base name by three characters and more, it is the key.
    """
    or_else = lambda a, b: F.coalesce(F.nullif(a, F.lit("")), b)
    plain = lambda c: once(or_else(strip_description(c), c), lambda t: or_else(strip_variant(t), t))
    full = F.coalesce(canonical, F.lit(""))
    month = F.nullif(F.regexp_extract(full, MATURITY, 1), F.lit(""))
    dated = once(plain(F.coalesce(base, F.lit(""))), lambda t: F.when(~t.rlike(r"(?:19|20)\d{2}") & month.isNotNull(), F.concat(t, F.lit(" - "), month)).otherwise(t))
    peeled = once(strip_description(cut(full, PLAN_TAILS)), lambda t: or_else(strip_variant(t), t))
    longer = lambda key, own: F.startswith(own, key) & (key != "") & (F.length(own) >= F.length(key) + 3)
    both = F.struct(dated.alias("a"), peeled.alias("b"))
    key = once(both, lambda x: F.when(longer(root_key(x["a"]), root_key(x["b"])), x["b"]).otherwise(x["a"]))
    return or_else(norm_text(key), norm_text(base))


def peel(c: Column) -> Column:
    """Candidates in order: the label, without a date at its end, without its first word."""
    dated = F.trim(F.regexp_replace(c, r"(?i)[\s_\-]*(?:as\s+(?:on|of)\b.*|\d{1,2}[\s_\-]*[a-z]{3,9}[\s_\-]*\d{2,4}|[a-z]{3,9}[\s_\-]*20\d{2})\s*$", ""))
    return F.array_distinct(F.filter(F.array(F.trim(c), dated, F.regexp_replace(dated, r"^\S+\s+", "")), lambda x: F.length(x) > 0))


def pack_code(stem: Column) -> Column:
    """A short code at a file name's start or end, or in brackets."""
    found = [F.nullif(F.regexp_extract(stem, p, 1), F.lit("")) for p in (r"^([A-Z0-9]{2,8})[_\-]", r"\(([A-Z0-9]{2,8})\)", r"[_\-]([A-Z]{2,8}\d{0,3})$")]
    return F.coalesce(*found)


def fund_from_file(stem: Column) -> Column:
    """Words of a file name, camel case split, dates and "portfolio" out."""
    t = F.regexp_replace(F.regexp_replace(stem, r"[_\-+]|%20", " "), r"(?<=[a-z])(?=[A-Z])", " ")
    return squeeze(F.regexp_replace(t, r"(?i)\b(?:\d{1,2}|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*|20\d{2}|monthly|fortnightly|portfolio|disclosure|final)\b", " "))


def is_shortcode(c: Column, blocked: tuple[str, ...] = ("NAV", "ISIN", "TOTAL", "INDEX")) -> Column:
    return c.rlike(r"^[A-Z0-9]{2,10}$") & c.rlike("[A-Z]") & ~c.isin(*blocked)


def looks_like_fund(c: Column) -> Column:
    return F.coalesce((F.length(c) >= 8) & c.rlike(r"(?i)\b(?:fund|etf|fof|scheme|plan|index)\b") & ~c.rlike(f"(?i){JUNK}"), F.lit(False))


def is_closed_end(c: Column) -> Column:
    return F.coalesce(c.rlike(f"(?i){CLOSED_END}"), F.lit(False))


def is_debt_like(c: Column) -> Column:
    return F.coalesce(c.rlike(f"(?i){DEBT_WORDS}"), F.lit(False))


def is_secondary(c: Column) -> Column:
    words = "|".join(w.replace(" ", r"\s+") for w in VARIANT_WORDS)
    return F.coalesce(c.rlike(rf"(?i)\b(?:{words})"), F.lit(False))
