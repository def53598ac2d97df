"""The dated store of books: nested JSON by date, latest mirror, catalog and filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import catalog as cat
from ..schemas import HOLDING, HOLDING_FIELDS

BOOK = T.StructType([T.StructField("portfolio_id", T.StringType()), T.StructField("member_codes", T.ArrayType(T.StringType())), T.StructField("as_of", T.DateType()), T.StructField("cadence", T.StringType()), T.StructField("holdings", T.ArrayType(HOLDING))])


def nest(holdings: DataFrame) -> DataFrame:
    """Flat holdings (portfolio_id, as_of, cadence, ordinal, fields) to one row a book, in order. A book is a sheet: 20,000 rows at most."""
    item = F.struct("ordinal", *HOLDING_FIELDS)
    books = holdings.groupBy("portfolio_id", "as_of", "cadence").agg(F.sort_array(F.collect_list(item)).alias("h"))
    return books.withColumn("holdings", F.transform("h", lambda x: F.struct(*[x[n].alias(n) for n in HOLDING_FIELDS]))).drop("h")


def write(books: DataFrame, path: str) -> None:
    """Replace the written dates, leave others."""
    books.write.option("partitionOverwriteMode", "dynamic").partitionBy("as_of").mode("overwrite").json(f"{path}/asof")


def merge(spark: SparkSession, books: DataFrame, path: str) -> None:
    """Add to the written dates; books of the same id are replaced. The old ones are read before they are overwritten."""
    old = read(spark, path)
    kept = old.join(books.select("as_of").distinct(), "as_of", "left_semi").join(books.select("as_of", "portfolio_id"), ["as_of", "portfolio_id"], "left_anti")
    both = kept.unionByName(books, allowMissingColumns=True)
    staged = f"{path}/_staged"
    both.write.mode("overwrite").parquet(staged)
    write(spark.read.parquet(staged), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All books; damaged files give no rows."""
    return spark.read.schema(BOOK).option("mode", "DROPMALFORMED").json(f"{path}/asof")


def publish_indexes(spark: SparkSession, path: str, catalog: DataFrame, least: int = 0) -> None:
    """latest/, catalog/ and filings/ from what is stored."""
    books = read(spark, path)
    cat.newest(books, "portfolio_id", "as_of").write.mode("overwrite").json(f"{path}/latest")
    seen = cat.availability(catalog.select("portfolio_id", F.explode("advertised").alias("as_of")), books)
    catalog.drop("advertised").join(seen, "portfolio_id", "left").write.mode("overwrite").json(f"{path}/catalog")
    cat.filings(books, least).write.mode("overwrite").json(f"{path}/filings")
