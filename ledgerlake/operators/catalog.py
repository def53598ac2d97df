"""Catalog, availability and exact-date serving of dated books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..rules import first_by


def newest(df: DataFrame, key: str, as_of: str, *ties: Column) -> DataFrame:
    """The newest row of each key."""
    return first_by(df, [key], [F.col(as_of).desc(), *ties])


def portfolio_index(catalog: DataFrame) -> DataFrame:
    """Per portfolio id: sorted member codes, and the canonical one: that equal to the id, else the least."""
    code = F.col("code")
    own = F.max(F.when(code == F.col("portfolio_id"), code))
    return catalog.groupBy("portfolio_id").agg(F.array_sort(F.collect_set(code)).alias("members"), F.coalesce(own, F.min(code)).alias("canonical"), F.countDistinct(code).alias("n_members"))


def resolve_id(codes: DataFrame, catalog: DataFrame) -> DataFrame:
    """code -> its portfolio id, else its parent, else itself."""
    look = catalog.select("code", F.col("portfolio_id").alias("__p"), F.col("parent").alias("__q"))
    return codes.join(look, "code", "left").withColumn("resolved", F.coalesce("__p", "__q", "code")).drop("__p", "__q")


def inherit_alias(catalog: DataFrame, aliases: DataFrame) -> DataFrame:
    """Orphans take their target's portfolio id, only where the target has one and they have none."""
    target = catalog.select(F.col("code").alias("target"), F.col("portfolio_id").alias("__t"))
    filled = aliases.join(target, "target").select(F.col("orphan").alias("code"), "__t")
    return catalog.join(filled, "code", "left").withColumn("inherited", F.col("portfolio_id").isNull() & F.col("__t").isNotNull()).withColumn("portfolio_id", F.coalesce("portfolio_id", "__t")).drop("__t")


def availability(advertised: DataFrame, books: DataFrame) -> DataFrame:
    """Per portfolio id: advertised dates that have a book, newest first, and the newest."""
    real = advertised.select("portfolio_id", "as_of").distinct().join(books.select("portfolio_id", "as_of").distinct(), ["portfolio_id", "as_of"])
    return real.groupBy("portfolio_id").agg(F.sort_array(F.collect_set("as_of"), asc=False).alias("available_as_of"), F.max("as_of").alias("latest_as_of"))


def filings(books: DataFrame, least: int = 0) -> DataFrame:
    """(as_of, cadence, portfolio_count), newest first; dates with fewer than ``least`` books go."""
    out = books.groupBy("as_of").agg(F.countDistinct("portfolio_id").alias("portfolio_count")).withColumn("cadence", dates.cadence(F.col("as_of")))
    return out.where(F.col("portfolio_count") >= least)


def merge_filings(existing: DataFrame, new: DataFrame) -> DataFrame:
    """By date and cadence; a later entry wins."""
    both = existing.withColumn("__r", F.lit(0)).unionByName(new.withColumn("__r", F.lit(1)))
    return first_by(both, ["as_of", "cadence"], [F.col("__r").desc(), F.col("portfolio_count").desc()]).drop("__r")


def write_slice(existing: DataFrame, new: DataFrame, key: str, merge: bool) -> DataFrame:
    """One date's books after a write: new ones, and when merging those existing that have no new one."""
    if not merge:
        return new
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def retained(books: DataFrame, as_of: str, months: int) -> DataFrame:
    """Rows from the first day of the month ``months - 1`` before the newest month-end."""
    d = F.col(as_of)
    newest_end = books.where(d == F.last_day(d)).agg(F.max(as_of).alias("m"))
    cut = newest_end.select(dates.retention_cutoff(F.col("m"), months).alias("__cut"))
    return books.join(F.broadcast(cut), d >= F.col("__cut")).drop("__cut")  # one row


def holdings_as_of(catalog: DataFrame, books: DataFrame, code: str, as_of: str | None = None) -> DataFrame:
    """The API's answer as one row: status, message, portfolio id, date, previous and next filings and whether they exist, holdings.

    A bad code or date is 400; an unknown code, one without holdings, or a missing book is 404.
    """
    spark = catalog.sparkSession
    q = spark.createDataFrame([(code, as_of)], "code string, raw string")
    q = q.withColumn("as_of", dates.normalize_as_of(F.col("raw")))
    q = q.join(catalog.select("code", F.col("portfolio_id").alias("pid"), "latest_as_of", F.lit(True).alias("known")), "code", "left")
    q = q.withColumn("want", F.when(F.col("raw").isNull(), F.col("latest_as_of")).otherwise(F.col("as_of")))
    kind = dates.cadence(F.col("want"))
    q = q.withColumn("previous", dates.previous_filing(F.col("want"), kind)).withColumn("next", dates.next_filing(F.col("want"), kind))
    own = books.where(F.col("portfolio_id").isin(*[r.portfolio_id for r in catalog.where(F.col("code") == code).select("portfolio_id").limit(1).collect()] or [""]))
    have = own.select(F.col("portfolio_id").alias("pid"), F.col("as_of").alias("d")).distinct()
    for name in ("previous", "next"):
        q = q.join(have.select("pid", F.col("d").alias(name), F.lit(True).alias(f"{name}_exists")), ["pid", name], "left")
    q = q.join(own.select(F.col("portfolio_id").alias("pid"), F.col("as_of").alias("want"), "holdings"), ["pid", "want"], "left")
    bad = ~F.col("code").rlike(r"^\d{4,8}$") | (F.col("raw").isNotNull() & F.col("as_of").isNull())
    status = F.when(bad, 400).when(F.col("known").isNull() | F.col("pid").isNull() | F.col("holdings").isNull(), 404).otherwise(200)
    message = F.when(bad, "Bad request").when(F.col("known").isNull(), "Unknown code").when(F.col("holdings").isNull(), "No data found")
    return q.select("code", F.col("pid").alias("portfolio_id"), F.col("want").alias("as_of"), status.alias("status"), message.alias("message"), "previous", F.coalesce("previous_exists", F.lit(False)).alias("previous_exists"), "next", F.coalesce("next_exists", F.lit(False)).alias("next_exists"), "holdings")


def search(catalog: DataFrame, wanted: str, columns: list[str], size: int = 60) -> DataFrame:
    """Rows that contain the text in any of the columns, those with holdings first."""
    q = F.lit(wanted.lower())
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), q), F.lit(False))
    return catalog.where(hit).orderBy(F.col("has_holdings").desc(), F.col(columns[0]), *catalog.columns[:1]).limit(size)


def siblings(catalog: DataFrame, code: str, parent: str) -> DataFrame:
    other = catalog.select(F.col(parent), F.col(code).alias("sibling"))
    return catalog.join(other, parent).where(F.col(code) != F.col("sibling"))


def public_row(catalog: DataFrame) -> DataFrame:
    """The four public fields; no dates are an empty list."""
    return catalog.select("code", "parent_name", F.coalesce("available_as_of", F.array().cast("array<date>")).alias("available_as_of"), "latest_as_of")


def rewritten(catalog: DataFrame, books: DataFrame) -> DataFrame:
    """Rows as they are synchronised: local fields go, and an id stays only where a book is linked to it."""
    have = books.select("portfolio_id").distinct().withColumn("__b", F.lit(True))
    out = catalog.drop("local_path", "portfolio_key", "portfolio_url").join(have, "portfolio_id", "left")
    linked = F.coalesce(F.col("has_holdings") & F.col("__b"), F.lit(False))
    return out.withColumn("portfolio_id", F.when(linked, F.col("portfolio_id"))).drop("__b")


def scheme_card(row: Column, name: str = "scheme") -> Column:
    """struct(code, name, house, category) of a catalog row."""
    return F.struct(row["code"].alias("code"), F.coalesce(row["parent_name"], row["code"]).alias("name"), row["amc_id"].alias("amc_id"), row["category"].alias("category")).alias(name)


def build(schemes: DataFrame, funds: DataFrame, books: DataFrame, mappings: DataFrame, aliases: DataFrame) -> DataFrame:
    """The browser's catalog: every scheme with the book that its plan, its fund, its short code or its name leads to; then books that none of them uses.

    schemes: code, name, amc_id. funds: canonical, base_name, codes. books: book_id, amc_id, code, shortcode, name
    (any may be null but book_id). mappings: map_id, amc_id, shortcode, name, parent, plan_codes. aliases: orphan,
    target. Where several rows compete the least map_id and book_id win; a book's mapping is found by its plan code,
    else by house and short code (any case), else by house and name.
    """
    key = lambda c: text.compact(F.col(c))
    fold = lambda c: F.lower(F.regexp_replace(F.col(c), r"[^A-Za-z0-9]", ""))
    plans = mappings.select("map_id", F.explode(F.array_distinct(F.concat("plan_codes", F.array("parent")))).alias("code")).where("code is not null")
    tries = [
        (books.select("book_id", "code"), first_by(plans, ["code"], [F.col("map_id")]), ["code"]),
        (books.select("book_id", "amc_id", fold("shortcode").alias("k")), first_by(mappings.select("map_id", "amc_id", fold("shortcode").alias("k")).where("k <> ''"), ["amc_id", "k"], [F.col("map_id")]), ["amc_id", "k"]),
        (books.select("book_id", "amc_id", key("name").alias("k")), first_by(mappings.select("map_id", "amc_id", key("name").alias("k")).where("k <> ''"), ["amc_id", "k"], [F.col("map_id")]), ["amc_id", "k"]),
    ]
    found = None
    for rank, (left, right, on) in enumerate(tries):
        hit = left.join(right, on).select("book_id", "map_id", F.lit(rank).alias("rank"))
        found = hit if found is None else found.unionByName(hit)
    mapped = books.join(first_by(found, ["book_id"], [F.col("rank"), F.col("map_id")]).select("book_id", "map_id"), "book_id", "left")
    # a book serves its mapping's plans and parent, and its own code
    serves = mapped.select("book_id", "map_id").join(plans, "map_id").select("book_id", "code").unionByName(mapped.where("code is not null").select("book_id", "code"))
    by_plan = first_by(serves, ["code"], [F.col("book_id")]).select("code", "book_id")
    heirs = aliases.join(by_plan.withColumnRenamed("code", "target"), "target").select(F.col("orphan").alias("code"), "book_id").join(by_plan.select("code"), "code", "left_anti")
    by_plan = by_plan.unionByName(first_by(heirs, ["code"], [F.col("book_id")]))
    # a fund's book is that of its canonical plan, else of its first plan that has one; all its plans share it
    members = funds.select("canonical", "base_name", F.posexplode(F.array_distinct(F.concat(F.array("canonical"), "codes"))).alias("pos", "code"))
    own = first_by(members.join(by_plan, "code"), ["canonical"], [F.col("pos")]).select("canonical", F.col("book_id").alias("fund_book"))
    parent = first_by(members, ["code"], [F.col("pos"), F.col("canonical")]).join(own, "canonical", "left").select("code", F.col("canonical").alias("parent_code"), "base_name", "fund_book")
    rows = schemes.join(parent, "code", "left").join(by_plan, "code", "left")
    rows = rows.select("code", "name", "amc_id", F.coalesce("base_name", "name").alias("parent_name"), "parent_code", F.coalesce("fund_book", "book_id").alias("book_id"))
    left = mapped.join(serves.select("book_id").distinct(), "book_id", "left_anti").select(F.lit(None).cast(schemes.schema["code"].dataType).alias("code"), F.coalesce("name", F.col("book_id").cast("string")).alias("name"), "amc_id", F.col("name").alias("parent_name"), F.lit(None).cast(funds.schema["canonical"].dataType).alias("parent_code"), "book_id")
    return rows.unionByName(left).withColumn("has_holdings", F.col("book_id").isNotNull())
