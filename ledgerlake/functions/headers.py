"""Other tables of header words than the table parser's: all fields a workbook may show, and the older extractor's six."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import has, ordered_case

# Fields that workbooks show and words that mark their headers, tried in this order
UNIVERSAL = {
    "security_code": r"^\s*(security\s*)?(code|no\.?)\s*$|^\s*sr\.?\s*no|^\s*scrip\s*code|^\s*sl\s*no|^\s*sr\s*$",
    "instrument": r"name\s+of\s+(the\s+)?(instrument|security|issuer)|company\s*/?\s*issuer\s*/?\s*instrument|instrument\s*/?\s*issuer|security\s+name|^(security|instrument|scrip|issuer|stock\s*name)\b",
    "isin": r"\bisin\b",
    "coupon": r"\bcoupon\b",
    "ytm": r"\bytm\b|yield\s*to\s*maturity",
    "ytc": r"\bytc\b|yield\s*to\s*call|at1|tier\s*2",
    "yield": r"\byield\b",
    "residual_maturity": r"residual|remaining\s*maturity|\btenor\b|term\s*to\s*maturity",
    "maturity_date": r"maturity\s*date|date\s*of\s*maturity|redemption\s*date|(?<!to )\bmaturity\b",
    "face_value": r"face\s*value|par\s*value|\bprincipal\b",
    "put_call_date": r"put\s*/?\s*call|call\s*date|put\s*date",
    "industry_rating": r"industry\s*[\^+\*]?\s*/\s*rating|rating\s*/\s*industry|industry\s+classification\s*/\s*rating",
    "rating": r"credit\s*rating|^\s*rating\b|conservative\s+rating",
    "rating_agency": r"rating\s*agency|\bicra\b|\bcrisil\b|\bcare\b|\bind[- ]?ra\b",
    "industry": r"\bindustry\b|\bsector\b",
    "quantity": r"^\s*quantity\b|\bqty\b|no\.?\s*of\s*(shares|units)|hedged\s+quantity|^\s*units\s*$",
    "futures_price": r"(futures?|option|contract)\s+price|current\s+price\s+of\s+the\s+contract",
    "market_value": r"market\s*/?\s*fair\s*value|market[\s\-]*value|mkt\.?\s*[\-]?\s*val|exposure\s*/\s*market|value\s*\(.*?(rs|inr|lakh|lac)|value\s+recognised\s+in\s+nav|total\s+security\s+value",
    "pct_nav": r"%\s*(to|of)?\s*(n\.?a\.?v|aum|net\s*assets?)|percent(age)?\s*(to|of)?\s*(n\.?a\.?v|aum|net\s*assets?)|%\s*to\s*nav|%\s*nav|^\s*percent\s*$",
    "macaulay_duration": r"macaulay",
    "modified_duration": r"modified\s*duration",
    "duration": r"\bduration\b",
    "listed_status": r"\blisted\b|\bunlisted\b",
    "exchange": r"\bexchange\b",
    "ticker": r"\bticker\b|\bsymbol\b|nse\s*code|bse\s*code",
    "accrued_interest": r"accrued\s*interest|interest\s*accrued",
    "clean_price": r"\bclean\s*price\b|\bdirty\s*price\b|\bprice\b",
    "asset_class": r"asset\s*(class|type)|instrument\s*type|type of security",
    "scheme_name": r"scheme\s*name|mutual\s+fund\s+name|type of scheme|^\s*scheme\s*$",
    "position_side": r"long\s*/\s*\(?\s*short|outstanding position in derivative",
    "margin": r"\bmargin\b",
    "market_cap": r"market\s*capital",
    "underlying": r"^\s*underlying\b",
    "trade_date": r"trade\s*date",
    "settlement_date": r"settlement\s*date",
    "remarks": r"\bremarks?\b|\bnotes?\b|\bfootnote",
}
# Headers that are no holding's field
IGNORED = r"\bbrsr\b|\besg\b|risk-?o-?meter|prc\s*matrix|potential\s+risk\s+class|assurance on|link to |interim repayment|top\s*\d+\s*issuers|transaction type|type of trade|value of the trade|price at which traded|at which traded|invit units of |^null$"
# The older extractor's columns, tried in this order, its hints of a header row and of a scheme's column
LEGACY = {
    "isin": r"^\s*isin\b|isin\s*code",
    "instrument": r"name\s+of\s+(the\s+)?(instrument|security)|security\s+name|instrument\s+name|^(security|instrument|scrip|stock)\b",
    "quantity": r"quantity|qty|no\.?\s*of\s*(shares|units)|units?\b",
    "market_value": r"market\s*value|mkt\.?\s*value|value\s*\(.*?(rs|inr|lac|lakh)",
    "pct_nav": r"%\s*(to|of)?\s*n\.?a\.?v|percent(age)?\s*(to|of)?\s*nav|%nav|%\s*(to|of)\s*net(\s*assets)?",
    "industry": r"industry|sector|rating|coupon",
}
ROW_HINTS = ("scheme", "security", "instrument", "isin", "issuer", "quantity", "qty", "market value", "market/fair", "market_value", "face value", "nav", "% to nav", "% to net", "percent", "holding", "rating", "industry", "sector", "coupon", "yield", "maturity")
SCHEME_HINTS = ("scheme", "fund")


def clean_header(c: Column) -> Column:
    """One line, single spaces, without marks at its ends."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]|_x000d_|_x000a_", " "), r"\s+", " ")
    return F.regexp_replace(F.trim(t), r"^[.:*|]+|[.:*|]+$", "")


def universal_field(c: Column) -> Column:
    """The field of a header: blank, ignore, one of ``UNIVERSAL``, or unmapped; null counts as blank."""
    h = clean_header(c)
    first = [((h == "") | has(h, r"^col(_\d+)?$") | (F.lower(h) == "null"), "blank"), (has(h, IGNORED), "ignore")]
    return ordered_case([*first, *((has(h, p), k) for k, p in UNIVERSAL.items())], "unmapped")


def legacy_names(headers: Column) -> Column:
    """The older extractor's names of a row's headers: each canonical name once, others as they stand, numbered where they recur."""

    def name(taken: Column, h: Column) -> Column:
        key = F.when(F.trim(h) == "", F.lit("col")).otherwise(F.trim(h))
        known = F.filter(F.array(*[F.when(has(key, p), F.lit(k)) for k, p in LEGACY.items()]), lambda n: n.isNotNull() & ~F.array_contains(taken, n))
        again = F.size(F.filter(taken, lambda t: (t == key) | (F.startswith(t, F.concat(key, F.lit("_"))) & F.substr(t, F.length(key) + 2).rlike(r"^\d+$"))))
        other = F.when(again == 0, key).otherwise(F.concat(key, F.lit("_"), (again + 1).cast("string")))
        return F.array_append(taken, F.coalesce(F.try_element_at(known, F.lit(1)), other))

    return F.aggregate(headers, F.array().cast("array<string>"), name)


def row_hints(cells: Column) -> Column:
    """How many of the older extractor's hints a row holds."""
    t = F.lower(F.array_join(F.filter(cells, lambda c: F.length(c) > 0), " | "))
    return sum((F.contains(t, F.lit(h)).cast("int") for h in ROW_HINTS), F.lit(0))


def scheme_column(headers: Column) -> Column:
    """The place (from 1) of the first header that tells a scheme; null: none."""
    hit = F.transform(headers, lambda h: sum((F.contains(F.lower(h), F.lit(w)).cast("int") for w in SCHEME_HINTS), F.lit(0)) > 0)
    return F.nullif(F.array_position(hit, True), F.lit(0)).cast("int")


def scheme_folder(c: Column, size: int = 180) -> Column:
    """A scheme's name as a folder: other characters than letters, digits and a few marks become one underscore."""
    t = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"(?U)[^\w.\-() ]+", "_"), r"\s+", " ")
    t = F.substring(F.regexp_replace(t, r"^[ ._]+|[ ._]+$", ""), 1, size)
    return F.when(t == "", F.lit("unknown")).otherwise(t)
