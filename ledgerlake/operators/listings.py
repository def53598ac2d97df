"""Disclosure listings: one landed table (amc_id, ordinal, url, title) and the ways of choosing from it.

Every fund house's connector reduces to a policy: which rows count, how their month is read, and which row of a
month (or name) wins. Policies are data; the expressions are shared.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..rules import first_by, has


@dataclass(frozen=True)
class Policy:
    """keep and drop: patterns on title and url; key: what one row is kept for; win: first, last, greatest_url, final_first or all."""

    keep: str = ""
    drop: str = ""
    key: str = "month"
    win: str = "first"
    prefer: str = ""
    from_url: bool = True
    scores: tuple[tuple[str, int], ...] = field(default=())


# Which row wins, by kind of listing
POLICIES = {
    "keep_all": Policy(win="all"),
    "first_per_month": Policy(),
    "last_per_month": Policy(win="last"),
    "first_per_url": Policy(key="url"),
    "last_per_url": Policy(key="url", win="last"),
    "first_per_name": Policy(key="name"),
    "greatest_url": Policy(win="greatest_url"),
    "final_first": Policy(win="final_first"),
    "monthly_only": Policy(keep="monthly|month", drop="fortnight", win="all"),
    "fortnightly_only": Policy(keep="fortnight", win="all"),
    "consolidated_first": Policy(prefer="consolidated|all\\s+(?:funds|schemes)"),
    "scored": Policy(win="scored", scores=(("portfolio", 4), ("monthly", 2), ("revised", 1), ("debt", -3))),
}


def file_name(url: Column) -> Column:
    return F.regexp_extract(url, r"([^/?#]+)(?:[?#].*)?$", 1)


def month_of(title: Column, url: Column, from_url: bool = True) -> Column:
    """The month a row is for: from its title, else from its file's name, else from a /yyyy/m/ path."""
    found = dates.last_month(F.replace(title, F.lit("_"), F.lit(" ")))
    if not from_url:
        return found
    path = F.regexp_extract(url, r"/(20\d{2})/(\d{1,2})/", 0)
    by_path = F.try_to_date(F.when(path != "", F.regexp_replace(path, r"^/(\d{4})/(\d{1,2})/$", "$1-$2-1")), "yyyy-M-d")
    return F.coalesce(found, dates.last_month(F.regexp_replace(file_name(url), r"[_%+]+(20)?", " $1")), by_path)


def select(listing: DataFrame, policy: Policy) -> DataFrame:
    """The rows that a policy keeps, with their month and file name."""
    df = listing.withColumn("name", file_name(F.col("url"))).withColumn("month", month_of(F.col("title"), F.col("url"), policy.from_url))
    words = F.concat_ws(" ", "title", "url")
    if policy.keep:
        df = df.where(has(words, policy.keep))
    if policy.drop:
        df = df.where(~has(words, policy.drop))
    keys = ["amc_id", policy.key]
    if policy.prefer:
        good = has(words, policy.prefer)
        best = df.groupBy(*keys).agg(F.max(good).alias("__any"))
        df = df.join(best, keys).where(~F.col("__any") | good).drop("__any")
    if policy.win == "all":
        return first_by(df, ["amc_id", "url"], [F.col("ordinal")])
    score = sum((F.when(has(words, p), n).otherwise(0) for p, n in policy.scores), F.lit(0))
    order = {
        "first": [F.col("ordinal")],
        "last": [F.col("ordinal").desc()],
        "greatest_url": [F.col("url").desc(), F.col("ordinal")],
        "final_first": [has(words, r"\bfinal\b").desc(), F.col("url").desc(), F.col("ordinal")],
        "scored": [score.desc(), F.col("url"), F.col("ordinal")],
    }[policy.win]
    return first_by(df.where(F.col(policy.key).isNotNull()), keys, order)


def with_slice(listing: DataFrame, target: Column) -> DataFrame:
    """Rows whose title names a day of the target's slice."""
    named = dates.parse_as_of(F.concat_ws(" ", "title", file_name(F.col("url"))))
    return listing.withColumn("named", named).where(dates.filing_slice(F.col("named")) == target)
