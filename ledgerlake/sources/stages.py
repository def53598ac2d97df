"""Tables staged in the shared folder, so that plans stay small and nothing is worked out twice."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset, and the master is local, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="shared"))
    return _OWN[0]


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def staged(df: DataFrame, keep: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lost executors cost only their tasks.

    The table goes when the session's process ends; with ``keep=False`` the caller deletes it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._staged_path = path
    if keep:
        atexit.register(forget, spark, path)
    return out


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join: the few bytes that a table of millions of short rows takes on disk get it broadcast, and the driver builds it in its memory."""
    return df.hint("merge")


def dealt(df: DataFrame) -> DataFrame:
    """``staged``, in four parts a core: for rows that are few but much work each."""
    spark = df.sparkSession
    return staged(df.repartition(4 * spark.sparkContext.defaultParallelism))


def forget(spark: SparkSession, path: str) -> None:
    if spark._jsc is not None and not spark._jsc.sc().isStopped():
        delete(spark, path)


def drop_stage(df: DataFrame) -> None:
    delete(df.sparkSession, df._staged_path)
