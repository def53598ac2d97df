"""Semicolon-delimited scheme masters, whose category and fund-house lines hold for the rows below them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import nav_date
from ..functions.text import text_or_null


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): each file is split inside one row, so that its order is sure."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return raw.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))


def parse(df: DataFrame) -> DataFrame:
    """Plans with their category and fund house.

    Rows have 6 (code; isin1; isin2; name; nav; date) or 8 columns; 8 are code; name; plan; option; isin1; isin2;
    nav; date where the file's header line names a plan, else code; name; isin1; isin2; nav; repurchase; sale; date.
    """
    p = F.split("line", ";")
    df = df.withColumn("p", p).withColumn("n", F.size("p"))
    w = Window.partitionBy("file")
    header = F.lower("line").startswith("scheme code")
    df = df.withColumn("with_plan", F.max(header & F.lower("line").contains("plan")).over(w))
    bare = (F.col("n") == 1) & (F.trim("line") != "")
    category = bare & F.lower("line").rlike(r"schemes?\s*\(")
    down = w.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("category", F.last(F.when(category, F.trim("line")), ignorenulls=True).over(down))
    df = df.withColumn("amc", F.last(F.when(bare & ~category, F.trim("line")), ignorenulls=True).over(down))
    rows = df.where(F.col("n").isin(6, 8) & F.trim(F.col("p")[0]).rlike(r"^\d+$"))
    at = lambda six, new, old: text_or_null(F.when(F.col("n") == 6, F.get("p", F.lit(six))).when(F.col("with_plan"), F.get("p", F.lit(new))).otherwise(F.get("p", F.lit(old))))
    return rows.select("file", F.trim(F.col("p")[0]).alias("code"), at(3, 1, 1).alias("name"), F.when((F.col("n") == 8) & F.col("with_plan"), text_or_null(F.get("p", F.lit(2)))).alias("plan"), F.when((F.col("n") == 8) & F.col("with_plan"), text_or_null(F.get("p", F.lit(3)))).alias("option"), at(1, 4, 2).alias("isin"), at(2, 5, 3).alias("isin_reinvest"), at(4, 6, 4).alias("nav"), nav_date(at(5, 7, 7)).alias("nav_date"), "amc", "category")


def plan_flags(name):
    """struct(direct, growth, idcw): true, false or unknown."""
    t = F.lower(name)
    direct = F.when(t.rlike(r"\bdirect\b"), True).when(t.rlike(r"\bregular\b|\bretail\b"), False)
    idcw = t.rlike(r"\bidcw\b|\bdividend\b|payout|reinvest|income distribution")
    growth = F.when(idcw, False).when(t.rlike(r"\bgrowth\b"), True)
    return F.struct(direct.alias("direct"), growth.alias("growth"), F.when(idcw, True).when(t.rlike(r"\bgrowth\b"), False).alias("idcw"))
