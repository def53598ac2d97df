"""Publication in versions: tables are written aside, then one small file, created once, makes them the current ones.

``root/data/<id>/<table>`` holds what a publication wrote, ``root/log/<n>.json`` names the tables of version n. A log
entry is written aside and renamed, without overwriting, so of two writers of one version the second fails and a
crash before that leaves the version before whole. Readers take the newest entry, or are pinned to one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another publication came first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _read(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))  # one small file


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    fs, p = _fs(spark, f"{root}/log")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def stage(tables: dict[str, DataFrame], root: str, partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write tables aside; nothing is published yet. Returns where each stands."""
    place, out = f"data/{uuid.uuid4().hex}", {}
    for name, df in tables.items():
        df.write.partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{root}/{place}/{name}")
        out[name] = f"{place}/{name}"
    return out


def commit(spark: SparkSession, root: str, staged: dict[str, str], after: int | None = None) -> int:
    """Publish staged tables as the version after ``after`` (the newest, unless told); tables not staged stay those of that version."""
    known = versions(spark, root)
    base = after if after is not None else (known[-1] if known else 0)
    entry = (_read(spark, f"{root}/log/{base}.json")["tables"] if base else {}) | staged
    fs, log = _fs(spark, f"{root}/log")
    fs.mkdirs(log)
    _, aside = _fs(spark, f"{root}/log/_{uuid.uuid4().hex}")
    _, target = _fs(spark, f"{root}/log/{base + 1}.json")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"version": base + 1, "tables": entry}, sort_keys=True).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, target, never_over)
    except Exception as e:
        fs.delete(aside, False)
        if fs.exists(target):
            raise Conflict(f"version {base + 1} was published meanwhile") from e
        raise
    return base + 1


def publish(tables: dict[str, DataFrame], root: str, **options) -> int:
    """Stage and commit; the newest version is read before the tables are, so what they were made from can't change unseen."""
    spark = next(iter(tables.values())).sparkSession
    known = versions(spark, root)
    return commit(spark, root, stage(tables, root, **options), known[-1] if known else 0)


def pinned(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (the newest, unless told); later publications don't change them."""
    known = versions(spark, root)
    if not known:
        return {}
    entry = _read(spark, f"{root}/log/{known[-1] if version is None else version}.json")
    return {name: spark.read.parquet(f"{root}/{place}") for name, place in entry["tables"].items()}


def expire(spark: SparkSession, root: str, keep: int) -> int:
    """Delete the log entries before the last ``keep`` versions and the data that no kept one names; returns how many versions went."""
    known = versions(spark, root)
    gone, kept = known[:-keep] if keep else known, known[-keep:] if keep else []
    held = {p.split("/")[1] for v in kept for p in _read(spark, f"{root}/log/{v}.json")["tables"].values()}
    old = {p.split("/")[1] for v in gone for p in _read(spark, f"{root}/log/{v}.json")["tables"].values()}
    for v in gone:
        fs, p = _fs(spark, f"{root}/log/{v}.json")
        fs.delete(p, False)
    for place in old - held:
        fs, p = _fs(spark, f"{root}/data/{place}")
        fs.delete(p, True)
    return len(gone)
