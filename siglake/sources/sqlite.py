"""Spark data source for SQLite result files.

A file that tasks can open is read by one of them, or by several over row id ranges
when it is large. The driver looks at file sizes only; each task finds the bounds of its
range. A file in any other store is read in one piece and opened in memory
(``unpacked``). A file that cannot be read yields a single row that holds only its path
and the message in ``ingest_error``.
"""

from __future__ import annotations

import json
import math
import os
import sqlite3
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from siglake.model import SCHEMAS, SOURCE
from siglake.sources.store import contents

FORMAT = "sqlite_results"
RUN_PARAMETERS = "runParameters"
METADATA = ("run", "runAttr", RUN_PARAMETERS)  # few rows, however large the file
BATCH_ROWS = 50_000

# Parameter table by file version: exactly one of the two is present.
PARAMETER_TABLES = {
    "runParam": ("paramKey", "paramValue", "paramOrder"),
    "runConfig": ("configKey", "configValue", "configOrder"),
}
PARAMETER_SCHEMA = "rowId long, runId long, key string, value string, ord int"
ARROW_TYPES = {
    "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()
}
BOOKKEEPING = f"{SOURCE} string, ingest_error string"


@dataclass
class FilePart(InputPartition):
    path: str
    part: int = 0
    parts: int = 1


def open_readonly(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def parameter_query(connection: sqlite3.Connection) -> str:
    names = {row[0] for row in connection.execute("SELECT name FROM sqlite_master")}
    present = [table for table in PARAMETER_TABLES if table in names]
    if len(present) != 1:
        raise ValueError(f"expected one of {list(PARAMETER_TABLES)}, found {present}")
    key, value, order = PARAMETER_TABLES[present[0]]
    return (
        f"SELECT rowid AS rowId, runId, {key} AS key, {value} AS value, {order} AS ord "
        f"FROM {present[0]}"
    )


def table_query(connection: sqlite3.Connection, table: str, wanted: list[str]) -> str:
    if table == RUN_PARAMETERS:
        return parameter_query(connection)
    present = {row[1] for row in connection.execute(f"PRAGMA table_info({table})")}
    if not present:
        raise ValueError(f"no table {table}")
    columns = [
        "rowid AS rowId" if c == "rowId" else c if c in present else f"NULL AS {c}"
        for c in wanted
    ]
    return f"SELECT {', '.join(columns)} FROM {table}"


def row_range(
    connection: sqlite3.Connection, table: str, part: int, parts: int
) -> tuple[int, int]:
    """First and last row id of one of several equal ranges; empty for an empty table."""
    low, high = connection.execute(f"SELECT min(rowid), max(rowid) FROM {table}").fetchone()
    if low is None:
        return 1, 0
    span = high - low + 1
    return low + span * part // parts, low + span * (part + 1) // parts - 1


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, table: str, paths: list[str], split_bytes: int):
        self.schema = schema
        self.table = table
        self.paths = paths
        self.split_bytes = split_bytes

    def partitions(self) -> list[FilePart]:
        found = []
        for path in self.paths:
            size = os.path.getsize(path) if os.path.exists(path) else 0
            parts = 1 if self.table in METADATA else max(1, math.ceil(size / self.split_bytes))
            found += [FilePart(path, part, parts) for part in range(parts)]
        return found

    def read(self, partition: FilePart | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no file
            return
        types = {f.name: f.dataType.simpleString() for f in self.schema}
        try:
            connection = open_readonly(partition.path)
            yield from table_batches(
                connection, self.table, partition.path, types, partition.part, partition.parts
            )
            connection.close()
        except (sqlite3.Error, ValueError, pa.ArrowException) as error:
            yield as_batch({SOURCE: [partition.path], "ingest_error": [str(error)]}, types)


def as_batch(values: dict[str, list], types: dict[str, str]) -> pa.RecordBatch:
    """Columns of the given types; those without values are missing."""
    size = len(values[SOURCE])
    return pa.record_batch({n: pa.array(values.get(n, [None] * size), ARROW_TYPES[t]) for n, t in types.items()})


def table_batches(
    connection: sqlite3.Connection, table: str, path: str, types: dict[str, str], part: int = 0, parts: int = 1
) -> Iterator[pa.RecordBatch]:
    """The rows of a table, or of one of several ranges of them."""
    data = [name for name in types if name not in (SOURCE, "ingest_error")]
    query, bounds = table_query(connection, table, data), ()
    if parts > 1:
        query += " WHERE rowid BETWEEN ? AND ?"
        bounds = row_range(connection, table, part, parts)
    cursor = connection.execute(query, bounds)
    while rows := cursor.fetchmany(BATCH_ROWS):
        yield as_batch(dict(zip(data, map(list, zip(*rows)))) | {SOURCE: [path] * len(rows)}, types)


def table_schema(table: str) -> str:
    columns = PARAMETER_SCHEMA if table == RUN_PARAMETERS else SCHEMAS[table]
    return f"{columns}, {BOOKKEEPING}"


def column_types(schema: str) -> dict[str, str]:
    """Names and types of a schema like those in ``model``."""
    return dict(column.split() for column in schema.split(", "))


def open_bytes(content: bytes) -> sqlite3.Connection:
    """A database in memory; what only its write-ahead log holds is not part of the file."""
    if content[18:20] == b"\x02\x02":  # written with such a log, which a database in memory cannot have
        content = content[:18] + b"\x01\x01" + content[20:]
    connection = sqlite3.connect(":memory:")
    connection.deserialize(content)
    return connection


def unpacked(spark: SparkSession, paths: Sequence[str], tables: Sequence[str], **options) -> DataFrame:
    """(source_file, table, batch) of files in any store: each is read once, for all its tables.

    A batch is some rows of a table as an Arrow stream; ``unpacked_rows`` makes rows of it.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for path, content, problem in zip(*[c.to_pylist() for c in files.columns]):
                for table in tables:
                    types = column_types(table_schema(table))
                    try:
                        if problem is not None:
                            raise ValueError(problem)
                        connection = open_bytes(content)
                        for batch in table_batches(connection, table, path, types):
                            yield _packed(path, table, batch)
                        connection.close()
                    except (sqlite3.Error, ValueError, pa.ArrowException) as error:
                        yield _packed(path, table, as_batch({SOURCE: [path], "ingest_error": [str(error)]}, types))

    return contents(spark, paths, **options).mapInArrow(unpack, f"{SOURCE} string, table string, batch binary")


def _packed(path: str, table: str, batch: pa.RecordBatch) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return pa.record_batch([[path], [table], [sink.getvalue().to_pybytes()]], [SOURCE, "table", "batch"])


def unpacked_rows(files: DataFrame, table: str) -> DataFrame:
    """The rows of one table of ``unpacked`` files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0):
                yield from pa.ipc.open_stream(packed.as_buffer())

    return files.where(F.col("table") == table).select("batch").mapInArrow(rows, table_schema(table))


class SqliteResults(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return table_schema(self.options["table"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(
            schema,
            self.options["table"],
            json.loads(self.options["paths"]),
            int(self.options.get("splitBytes", 256 << 20)),
        )
