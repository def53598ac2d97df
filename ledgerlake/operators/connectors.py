"""Fund houses' listings as data: how a landed page is read, and which policy chooses from it.

reader: anchors (links of a page), years (links under year headings), tree (nested JSON), script (JSON after a
marker), rows (a flat landed table). The policy names are those of ``listings.POLICIES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import pages, trees
from . import listings

# House, reader, policy of its monthly and of its fortnightly listing
HOUSES = {
    "360_one": ("years", "final_first", "first_per_url"), "abakkus": ("tree", "first_per_url", "first_per_url"), "absl": ("rows", "keep_all", "keep_all"), "angel_one": ("script", "monthly_only", "fortnightly_only"),
    "axis": ("rows", "consolidated_first", "keep_all"), "bajaj": ("rows", "monthly_only", "fortnightly_only"), "bandhan": ("rows", "first_per_url", "keep_all"), "baroda_bnp": ("rows", "last_per_url", "keep_all"),
    "boi": ("rows", "greatest_url", "fortnightly_only"), "canara_robeco": ("anchors", "first_per_url", "first_per_url"), "capitalmind": ("anchors", "keep_all", "keep_all"), "choice": ("tree", "keep_all", "keep_all"),
    "dsp": ("anchors", "first_per_month", "keep_all"), "edelweiss": ("rows", "keep_all", "keep_all"), "franklin": ("rows", "last_per_month", "keep_all"), "groww": ("tree", "monthly_only", "fortnightly_only"),
    "hdfc": ("rows", "keep_all", "keep_all"), "helios": ("anchors", "monthly_only", "fortnightly_only"), "hsbc": ("anchors", "first_per_url", "first_per_url"), "icici": ("rows", "keep_all", "keep_all"),
    "ilfs": ("anchors", "scored", "keep_all"), "invesco": ("tree", "keep_all", "keep_all"), "iti": ("tree", "keep_all", "keep_all"), "jio_blackrock": ("script", "keep_all", "keep_all"),
    "jm_financial": ("rows", "keep_all", "keep_all"), "kotak": ("tree", "consolidated_first", "first_per_url"), "lic": ("anchors", "first_per_url", "first_per_url"), "mahindra": ("tree", "keep_all", "keep_all"),
    "mirae": ("rows", "keep_all", "keep_all"), "motilal": ("rows", "monthly_only", "fortnightly_only"), "navi": ("rows", "keep_all", "keep_all"), "nippon": ("anchors", "first_per_month", "keep_all"),
    "nj": ("anchors", "first_per_url", "first_per_url"), "old_bridge": ("anchors", "first_per_url", "first_per_url"), "pgim": ("tree", "keep_all", "keep_all"), "ppfas": ("anchors", "first_per_url", "first_per_url"),
    "quantum": ("anchors", "last_per_month", "last_per_month"), "samco": ("anchors", "first_per_name", "first_per_name"), "sbi": ("anchors", "first_per_url", "first_per_url"), "shriram": ("anchors", "scored", "keep_all"),
    "sundaram": ("anchors", "monthly_only", "fortnightly_only"), "tata": ("script", "monthly_only", "fortnightly_only"), "taurus": ("anchors", "first_per_url", "first_per_url"), "trust": ("rows", "keep_all", "keep_all"),
    "unifi": ("anchors", "first_per_url", "first_per_url"), "union": ("anchors", "first_per_url", "first_per_url"), "uti": ("rows", "keep_all", "keep_all"), "wealth_company": ("script", "first_per_url", "first_per_url"),
}


MONTHLY, FORTNIGHTLY = "monthly", "fortnightly"
# What a house's rows must say, of what (title, url, both, or the file's name), what they mustn't unless they also say something, and which files count
FILTERS = (
    ("angel_one", MONTHLY, "name", r"monthly[-_\s]*portfolio", r"\baaum\b|half[-_\s]*year", "", ""),
    ("axis", MONTHLY, "both", "monthly", "weekly", "", r"\.(pdf|xls|xlsx|xlsb)(\?.*)?$"),
    ("bajaj", MONTHLY, "both", "monthly|portfolio", "fortnightly", "", r"\.xlsx?(\?|$)"),
    ("bajaj", FORTNIGHTLY, "both", "fortnightly", "", "", r"\.xlsx?(\?|$)"),
    ("boi", FORTNIGHTLY, "name", r"^\d{8}_", "", "", ""),
    ("groww", MONTHLY, "title", "monthly portfolio", "fortnightly", "", r"\.xlsx?(\?|$)"),
    ("helios", MONTHLY, "name", "portfolio|monthly|monthtly|^helios-", "fortnightly", "", ""),
    ("helios", FORTNIGHTLY, "name", "fortnightly", "", "", ""),
    ("hsbc", MONTHLY, "url", "/portfolios/", "", "", r"\.xlsx?(?:\?|$)"),
    ("ilfs", MONTHLY, "url", "portfolio|monthly", "fortnight|halfyear", "", r"\.(xlsx|xls|zip|pdf)(\?|$)"),
    ("mahindra", MONTHLY, "both", "", "fortnight", "", ""),
    ("mahindra", FORTNIGHTLY, "both", "fortnight", "", "", ""),
    ("motilal", MONTHLY, "both", "", "fortnight", "", r"\.(xlsx?|xlsb)(\?|$)"),
    ("motilal", FORTNIGHTLY, "both", "fortnight", "", "", r"\.(xlsx?|xlsb)(\?|$)"),
    ("nippon", MONTHLY, "title", "monthly portfolio", "", "", ""),
    ("nippon", FORTNIGHTLY, "title", "fortnightly|debt schemes portfolio", "", "", ""),
    ("sundaram", MONTHLY, "title", "", "fortnightly", "monthly", ""),
    ("sundaram", FORTNIGHTLY, "title", "fortnightly", "", "", ""),
    ("union", MONTHLY, "both", "monthly[- ]portfolio", "fortnight|weekly", "", r"\.(xlsx|xls|xlsb|pdf)(\?|$)"),
)
RULE = "house string, cadence string, part string, keep string, drop string, unless string, files string"


def filters(spark: SparkSession) -> DataFrame:
    """The houses' own filters as a table."""
    return spark.createDataFrame(list(FILTERS), RULE)


def filtered(listing: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of a listing (house, cadence, title, url, ...) that their house's own filter of that cadence lets through; houses without one keep all.

    All houses are judged in one pass: rules are joined, and their patterns searched, as columns. Any case counts; a
    null title or address says nothing. A house and cadence have one rule.
    """
    title, url = F.coalesce("title", F.lit("")), F.coalesce("url", F.lit(""))
    name = F.regexp_extract(url, r"([^/?#]+)(?:[?#].*)?$", 1)
    said = F.when(F.col("part") == "title", title).when(F.col("part") == "url", url).when(F.col("part") == "name", name).otherwise(F.concat_ws(" ", title, url))
    hit = lambda text, rule: F.regexp_like(text, F.concat(F.lit("(?i)"), F.col(rule)))
    j = listing.join(F.broadcast(rules), ["house", "cadence"], "left").withColumn("said", said)  # a row a house and cadence
    drop = (F.col("drop") != "") & hit(F.col("said"), "drop") & ~((F.col("unless") != "") & hit(F.col("said"), "unless"))
    fits = hit(F.col("said"), "keep") & ~drop & hit(url, "files")
    return j.where(F.col("part").isNull() | fits).select(*listing.columns)


def read(landed: DataFrame, reader: str, marker: str = "=") -> DataFrame:
    """Landed pages (page_id, amc_id, url, html) as a listing (amc_id, ordinal, url, title)."""
    if reader in ("anchors", "years"):
        links = pages.links_with_year(landed)
        found = links.select("page_id", F.col("pos").alias("ordinal"), F.col("href").alias("link"), F.concat_ws(" ", "label", "year").alias("title"))
    else:
        files = trees.files(landed, "page_id", "html", marker if reader == "script" else None)
        found = files.select(F.col("id").alias("page_id"), F.col("pos").alias("ordinal"), F.col("url").alias("link"), F.concat_ws(" ", "path", "title").alias("title"))
    base = landed.select("page_id", "amc_id", F.col("url").alias("base"))
    return found.join(base, "page_id").select("amc_id", "ordinal", pages.absolute(F.col("base"), F.col("link")).alias("url"), "title")


def choose(landed: DataFrame, house: str, fortnightly: bool = False, marker: str = "=") -> DataFrame:
    """A house's listing under its policy."""
    reader, monthly, other = HOUSES[house]
    listing = landed if reader == "rows" else read(landed, reader, marker)
    cadence = FORTNIGHTLY if fortnightly else MONTHLY
    rows = listing.withColumn("house", F.lit(house)).withColumn("cadence", F.lit(cadence))
    listing = filtered(rows, filters(landed.sparkSession)).select(*listing.columns)
    return listings.select(listing, listings.POLICIES[other if fortnightly else monthly])


def derive_next_month(listing: DataFrame, shift: int = 1) -> DataFrame:
    """Addresses of a later month made from a reference month's: the month's name and year are moved on."""
    moved = F.add_months("month", shift)
    url = F.regexp_replace(F.col("url"), F.date_format("month", "MMMM"), F.date_format(moved, "MMMM"))
    url = F.regexp_replace(url, F.date_format("month", "yyyy"), F.date_format(moved, "yyyy"))
    return listing.select("amc_id", "ordinal", url.alias("url"), moved.alias("month"))


def wide_months(df: DataFrame, key: str) -> DataFrame:
    """Twelve month columns of addresses as rows (key, month_name, url)."""
    months = [c for c in df.columns if c != key]
    return df.unpivot([key], months, "month_name", "url").where("url is not null and url <> ''")
