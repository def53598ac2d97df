"""Landed listings as a registered data source that plans its own partitions.

A landing zone holds listings as JSON lines in ``house=.../cadence=.../period=...`` folders. The source lists the folder
when a query is planned, drops files whose folder can't satisfy the query's filters, and reads one file a task, in
Arrow batches. A house's own form of listing is a subclass that overrides ``listed``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

KEYS = ("house", "cadence", "period")
SCHEMA = "house string, cadence string, period string, ordinal long, url string, title string, file string"
_LISTED = pa.schema([("ordinal", pa.int64()), ("url", pa.string()), ("title", pa.string())])
_ROW = pa.schema([*((k, pa.string()) for k in KEYS), *_LISTED, ("file", pa.string())])
_ORDERED = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


@dataclass
class Landed(InputPartition):
    """One listing file and what its folders say."""

    path: str
    keys: dict[str, str]


def folder_keys(path: str) -> dict[str, str]:
    """What ``name=value`` folders say; others say nothing."""
    parts = dict(p.split("=", 1) for p in path.split("/")[:-1] if "=" in p)
    return {k: parts[k] for k in KEYS if k in parts}


def fits(keys: dict[str, str], f: Filter) -> bool:
    """Whether a file in a folder may hold rows that satisfy a filter on a folder's key; a folder that doesn't say is null there."""
    have = keys.get(f.attribute[0])
    if isinstance(f, EqualNullSafe):
        return have == f.value
    if have is None:
        return False
    if isinstance(f, EqualTo):
        return have == f.value
    if isinstance(f, In):
        return have in f.value
    return _ORDERED[type(f)](have, f.value)


class ListingReader(DataSourceReader):
    def __init__(self, source: ListingSource):
        self.source = source
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on the folders' keys are settled here, whole; the others go back to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, EqualNullSafe, In, *_ORDERED)) and len(f.attribute) == 1 and f.attribute[0] in KEYS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pafs.FileSystem.from_uri(self.source.options["path"])
        files = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        landed = [Landed(f.path, folder_keys(f.path)) for f in files if f.is_file and f.base_name.endswith(".json") and not f.base_name.startswith((".", "_"))]
        return [p for p in sorted(landed, key=lambda p: p.path) if all(fits(p.keys, f) for f in self.filters)]

    def read(self, partition: Landed) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.source.options["path"])
        with fs.open_input_stream(partition.path) as stream:
            listed = self.source.listed(partition.keys, stream)
        keys = [pa.array([partition.keys.get(k)] * len(listed), pa.string()) for k in KEYS]
        file = pa.array([partition.path.rsplit("/", 1)[-1]] * len(listed), pa.string())
        yield from pa.Table.from_arrays([*keys, *(listed.column(n) for n in _LISTED.names), file], schema=_ROW).to_batches()


class ListingSource(DataSource):
    """``spark.read.format("ledger_listing").load(folder)``: rows with an address, of all listings in the folder."""

    @classmethod
    def name(cls) -> str:
        return "ledger_listing"

    def schema(self) -> str:
        return SCHEMA

    def listed(self, keys: dict[str, str], stream) -> pa.Table:
        """A listing file's rows: ordinal, url, title."""
        raw = stream.read()
        if not raw.strip():
            return _LISTED.empty_table()
        table = pajson.read_json(pa.BufferReader(raw), parse_options=pajson.ParseOptions(explicit_schema=_LISTED, unexpected_field_behavior="ignore"))
        table = table.select(_LISTED.names)
        return table.filter(pc.fill_null(pc.greater(pc.utf8_length(table.column("url")), 0), False))

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self)


def register(spark: SparkSession, source: type[ListingSource] = ListingSource) -> None:
    """Make a source known to a session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
