"""Exports: flat books, match matrices by house, the durable code map, the mapping workbook's tables, and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rules import first_by

# Columns of the flat book in this order
BOOK_COLUMNS = (
    "scheme_name", "as_of", "section", "instrument", "isin", "industry", "industry_rating", "rating", "rating_agency", "quantity", "market_value", "pct_nav", "coupon", "ytm", "ytc", "instrument_yield", "residual_maturity", "maturity_date", "face_value", "put_call_date",
    "futures_price", "macaulay_duration", "modified_duration", "duration", "listed_status", "accrued_interest", "position_side", "margin", "underlying", "asset_class",
)


def flat_book(holdings: DataFrame) -> DataFrame:
    """Every column of the flat book, null where the holdings have none."""
    return holdings.select(*[F.col(c).cast("string").alias(c) if c in holdings.columns else F.lit(None).cast("string").alias(c) for c in BOOK_COLUMNS])


def write_book(holdings: DataFrame, path: str) -> None:
    flat_book(holdings).write.option("header", "true").mode("overwrite").csv(path)


def durable_map(entries: DataFrame) -> DataFrame:
    """One row a house and code; a confirmed or manual binding beats others, the later row wins otherwise only where it is confirmed; aliases of all rows are kept.

    entries: amc_id, shortcode, aliases, code, confidence, ordinal.
    """
    e = entries.withColumn("shortcode", F.trim("shortcode")).where("shortcode <> '' and amc_id <> '' and code is not null")
    sure = F.coalesce(F.col("confidence").isin("confirmed", "manual"), F.lit(False))
    best = first_by(e, ["amc_id", "shortcode"], [sure.desc(), F.col("ordinal")]).select("amc_id", "shortcode", "code", F.coalesce("confidence", F.lit("seeded")).alias("confidence"))
    names = e.select("amc_id", "shortcode", F.explode(F.coalesce("aliases", F.array().cast("array<string>"))).alias("a")).select("amc_id", "shortcode", F.trim("a").alias("a")).where("a <> '' and a <> shortcode")
    names = names.groupBy("amc_id", "shortcode").agg(F.array_join(F.array_sort(F.collect_set("a")), "|").alias("aliases"))
    return best.join(names, ["amc_id", "shortcode"], "left").na.fill("", ["aliases"])


def write_durable_map(entries: DataFrame, path: str) -> None:
    durable_map(entries).orderBy("amc_id", "shortcode").write.option("header", "true").mode("overwrite").csv(path)


def match_summary(matches: DataFrame) -> DataFrame:
    """Per house: rows by status and the share that matched."""
    return matches.groupBy("amc_id").agg(F.count("*").alias("rows"), F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") != "matched").alias("open")).withColumn("pct", F.round(F.col("matched") * 100 / F.col("rows"), 2))


def write_matrices(matches: DataFrame, path: str) -> None:
    """The matrix of each house under its own folder, and the summary."""
    matches.write.partitionBy("amc_id").mode("overwrite").json(f"{path}/matrices")
    match_summary(matches).write.mode("overwrite").json(f"{path}/_summary")


def write_mapping_tables(mappings: DataFrame, parents: DataFrame, unmatched: DataFrame, path: str) -> None:
    """The mapping workbook's sheets as CSV tables (styling is left out)."""
    for name, df in (("mappings", mappings), ("parents", parents), ("unmatched", unmatched), ("summary", match_summary(mappings))):
        flat = df.select(*[F.array_join(c, "|").alias(c) if dict(df.dtypes)[c].startswith("array") else F.col(c) for c in df.columns])
        flat.write.option("header", "true").mode("overwrite").csv(f"{path}/{name}")


def write_links(links: DataFrame, path: str) -> None:
    """Links by house."""
    links.write.partitionBy("amc_id").option("header", "true").mode("overwrite").csv(path)
