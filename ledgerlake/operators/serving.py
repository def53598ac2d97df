"""Read routes over the catalog and the books: many requests at once, each a row, each answered by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..sources.paths import api_link
from . import catalog as cat

CODE = r"^\d{4,8}$"
KEY = r"^[a-z]+/[A-Za-z0-9._/-]+\.json$"
MOST_SCHEMES = 5000


def valid_code(code: Column) -> Column:
    return F.coalesce(F.trim(code).rlike(CODE), F.lit(False))


def valid_key(key: Column) -> Column:
    """A stored book's key: below one of the known folders, without a way up."""
    return F.coalesce(key.rlike(KEY) & ~key.contains("..") & key.rlike("^(portfolios|catalog|filings)/"), F.lit(False))


def answers(requests: DataFrame, catalog: DataFrame, books: DataFrame) -> DataFrame:
    """Status, portfolio id, date and the links of every request (request_id, code, as_of text or null).

    400: a bad code or date; 404: a code that the catalog lacks, or a date without a book; else 200. Links are null
    where no book is.
    """
    q = requests.withColumn("bad", ~valid_code(F.col("code")) | (F.col("as_of").isNotNull() & dates.normalize_as_of(F.col("as_of")).isNull()))
    q = q.join(catalog.select("code", "portfolio_id", "latest_as_of", F.lit(True).alias("known")), "code", "left")
    q = q.withColumn("day", F.coalesce(dates.normalize_as_of(F.col("as_of")), F.when(F.col("as_of").isNull(), F.col("latest_as_of"))))
    kind = dates.cadence(F.col("day"))
    q = q.withColumn("previous", dates.previous_filing(F.col("day"), kind)).withColumn("next", dates.next_filing(F.col("day"), kind))
    have = books.select("portfolio_id", F.col("as_of").alias("d")).distinct()
    for name in ("day", "previous", "next"):
        q = q.join(have.withColumnsRenamed({"d": name}).withColumn(f"has_{name}", F.lit(True)), ["portfolio_id", name], "left")
    status = F.when(F.col("bad"), 400).when(F.col("known").isNull() | F.col("has_day").isNull(), 404).otherwise(200)
    link = lambda name: F.when(F.col(f"has_{name}") & ~F.col("bad"), api_link(F.col("code"), F.col(name)))
    return q.select("request_id", "code", status.alias("status"), "portfolio_id", F.when(~F.col("bad"), F.col("day")).alias("as_of"), link("previous").alias("previous"), link("day").alias("self"), link("next").alias("next"))


def schemes(catalog: DataFrame, wanted: str = "", amc_id: str | None = None, most: int = MOST_SCHEMES) -> DataFrame:
    """The comparison page's list: a house's schemes that contain the text, by name (a route's length)."""
    df = catalog if amc_id is None else catalog.where(F.col("amc_id") == amc_id)
    hit = F.lower("name").contains(wanted.lower()) | F.col("code").cast("string").contains(wanted) if wanted else F.lit(True)
    return df.where(hit).orderBy("name", "code").limit(most)


def holdings_answers(requests: DataFrame, catalog: DataFrame, books: DataFrame) -> DataFrame:
    """``answers`` for requests by code, else by a stored key, else by a stored path (request_id, code, key, path, as_of).

    Keys and paths are allowed if the catalog (code, portfolio_id, latest_as_of, key, path) has them, else 404; a
    request that names nothing, or a key of another form, is a 400. A key or path of several codes stands for the least.
    """
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    q = requests.select("request_id", text("code").alias("by_code"), text("key").alias("by_key"), text("path").alias("by_path"), "as_of")
    for c in ("key", "path"):
        least = catalog.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"by_{c}")).agg(F.min("code").alias(f"{c}_code"))
        q = q.join(least, f"by_{c}", "left")
    said = F.when(F.col("by_code").isNotNull(), F.col("by_code")).when(F.col("by_key").isNotNull(), F.col("key_code")).otherwise(F.col("path_code"))
    q = q.withColumn("code", said)
    nothing = F.coalesce("by_code", "by_key", "by_path").isNull()
    bad_key = F.col("by_code").isNull() & F.col("by_key").isNotNull() & ~valid_key(F.col("by_key"))
    early = F.when(nothing | bad_key, 400).when(F.col("by_code").isNull() & F.col("code").isNull(), 404)
    got = answers(q.select("request_id", "code", "as_of"), catalog.select("code", "portfolio_id", "latest_as_of"), books)
    return got.join(q.select("request_id", early.alias("early")), "request_id").withColumn("status", F.coalesce("early", "status")).drop("early")


def search(schemes: DataFrame, wanted: str, columns: tuple[str, ...] = ("scheme", "amc_id", "shortcode", "folder"), most: int = MOST_SCHEMES) -> DataFrame:
    """The comparison page's search: rows of which a column contains the text, any case, and how many there are in all (a route's length)."""
    t = F.lit(wanted.strip().lower())
    hit = schemes.where(F.exists(F.array(*[F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]), lambda c: F.contains(c, t)))
    total = hit.agg(F.count("*").alias("count"))
    return hit.orderBy(*columns).limit(most).crossJoin(F.broadcast(total))  # one row


def hints(maps: DataFrame) -> DataFrame:
    """key, codes: scheme codes by short code or folder, any case, each code once in order (maps: key, code, ordinal)."""
    m = maps.select(F.upper(F.trim("key")).alias("key"), F.trim("code").alias("code"), "ordinal").where("key <> '' and code <> ''")
    first = m.groupBy("key", "code").agg(F.min("ordinal").alias("ordinal"))
    return first.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "code"))), lambda x: x["code"]).alias("codes"))


def register(spark: SparkSession, catalog: DataFrame, filings: DataFrame, books: DataFrame) -> None:
    """The documented routes as views: v_catalog, v_filings, v_book."""
    cat.public_row(catalog).createOrReplaceTempView("v_catalog")
    filings.createOrReplaceTempView("v_filings")
    books.createOrReplaceTempView("v_book")
