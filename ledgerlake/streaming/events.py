"""Event streams from files: late duplicates, windows, half-month slices, and upserts by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import target_slice


def source(spark: SparkSession, folder: str, schema, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def deduplicated(events: DataFrame, keys: list[str], time: str = "ts", late: str = "45 days") -> DataFrame:
    """The first of equal keys, for as long as the watermark keeps them."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def tumbling(events: DataFrame, width: str, time: str = "ts", late: str = "45 days", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sliding(events: DataFrame, width: str, step: str, time: str = "ts") -> DataFrame:
    return events.groupBy(F.window(time, width, step).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str, key: str = "user_id", time: str = "ts") -> DataFrame:
    return events.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def half_months(events: DataFrame, time: str = "ts") -> DataFrame:
    """Irregular half-month buckets as a derived key."""
    return events.groupBy(target_slice(F.to_date(time)).alias("slice")).agg(F.count("*").alias("n"))


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Everything there is, then stop; the checkpoint resumes the next run."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def upsert_batches(stream: DataFrame, out: str, checkpoint: str, key: str, slice_: str) -> None:
    """Late and partial refreshes merge into their slice: new rows replace those of equal key.

    A batch's merged slices are written whole to a folder of their own before they replace the old ones. A batch that
    is run again after a crash finds them there, complete, and replaces the slices from them, so none is lost.
    """

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        merged = f"{out}_next/{number}"
        if not _exists(spark, f"{merged}/_SUCCESS"):
            batch = batch.dropDuplicates([slice_, key])
            if _exists(spark, f"{out}/_SUCCESS"):
                touched = batch.select(slice_).distinct()
                old = spark.read.parquet(out).join(touched, slice_, "left_semi")
                batch = old.join(batch.select(slice_, key), [slice_, key], "left_anti").unionByName(batch)
            batch.write.mode("overwrite").parquet(merged)
        spark.read.parquet(merged).write.option("partitionOverwriteMode", "dynamic").partitionBy(slice_).mode("overwrite").parquet(out)
        if number > 0:  # the batch before is done for good
            p = spark._jvm.org.apache.hadoop.fs.Path(f"{out}_next/{number - 1}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
