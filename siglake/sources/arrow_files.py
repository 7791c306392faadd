"""Arrow (Feather) files: a data source that reads and writes them.

Files that tasks can open are read by one task per run of record batches. Files in any
other store are read by Spark, each in one piece.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from siglake.model import FRAME, PART, ROW, SOURCE, nan_to_null
from siglake.sources.store import contents, listing, qualified, split_by_reach

FORMAT = "arrow_files"
ARROW_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
    "string": pa.string(), "boolean": pa.bool_(), "smallint": pa.int16(), "tinyint": pa.int8(),
}


ARROW_TYPES |= {
    "date": pa.date32(), "timestamp": pa.timestamp("us", "UTC"), "timestamp_ntz": pa.timestamp("us"),
    "decimal(20,0)": pa.decimal128(20, 0),
}
LARGER = {
    "smallint": [pa.uint8()], "int": [pa.uint16()], "bigint": [pa.uint32()],
    "decimal(20,0)": [pa.uint64()], "float": [pa.float16()],
}
WHOLE = ["tinyint", "smallint", "int", "bigint", "decimal(20,0)"]


LZ4 = pa.ipc.IpcWriteOptions(compression="lz4")


@dataclass
class Batches(InputPartition):
    path: str
    first: int
    last: int


def sql_type(arrow: pa.DataType) -> str:
    """Spark type of a column; categories are read as their values, unsigned numbers in the next larger type."""
    if pa.types.is_dictionary(arrow):
        return sql_type(arrow.value_type)
    if pa.types.is_large_string(arrow):
        return "string"
    if pa.types.is_timestamp(arrow):
        return "timestamp" if arrow.tz else "timestamp_ntz"
    if pa.types.is_date(arrow):
        return "date"
    for name, kinds in LARGER.items():
        if arrow in kinds:
            return name
    for name, known in ARROW_TYPES.items():
        if arrow == known:
            return name
    raise ValueError(f"column type {arrow} is not supported")


def widened(a: str, b: str) -> str:
    """A type that holds the values of both."""
    if a == b:
        return a
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if {a, b} <= {*WHOLE, "float", "double"}:
        return "double"
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp" if "timestamp" in (a, b) else "timestamp_ntz"
    return "string"


def _footer(path: str, reader: pa.ipc.RecordBatchFileReader) -> pa.RecordBatch:
    columns = {f.name: sql_type(f.type) for f in reader.schema}
    return pa.record_batch([[path], [reader.num_record_batches], [json.dumps(columns)]], ["path", "n", "columns"])


def footers(spark: SparkSession, local: list[str], stored: list[str]) -> tuple[dict[str, str], dict[str, int]]:
    """Type of each column over all files, and record batches of each file; read by tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with pa.memory_map(path) as file:
                    yield _footer(path, pa.ipc.open_file(file))

    def read_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, reader in _open_all(batches):
            yield _footer(path, reader)

    listed = spark.createDataFrame([(p,) for p in dict.fromkeys(local)], "path string")
    tasks = min(len(local), 4 * spark.sparkContext.defaultParallelism) or 1
    schema = "path string, n long, columns string"
    rows = listed.repartition(tasks).mapInArrow(read, schema)
    if stored:
        rows = rows.unionByName(contents(spark, stored).mapInArrow(read_bytes, schema))
    found = {r["path"]: r for r in rows.collect()}
    types: dict[str, str] = {}
    for path in [*local, *stored]:
        for name, kind in json.loads(found[path]["columns"]).items():
            types[name] = widened(types.get(name, kind), kind)
    return types, {path: row["n"] for path, row in found.items()}


def _open_all(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.ipc.RecordBatchFileReader]]:
    for files in batches:
        for path, content, problem in zip(*files.columns):
            if problem.is_valid:
                raise ValueError(f"{path}: {problem}")
            yield path.as_py(), pa.ipc.open_file(content.as_buffer())


def frame_batch(batch: pa.RecordBatch, path: str, index: int, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """The batch with the given columns; file and place of a row unless it was saved with its own."""
    size, columns = batch.num_rows, {}
    for name, kind in types.items():
        if name in batch.schema.names:
            column = batch.column(batch.schema.names.index(name))
            if pa.types.is_dictionary(column.type):
                column = column.dictionary_decode()
            columns[name] = pc.cast(column, kind, safe=not pa.types.is_floating(kind))
        elif name in (SOURCE, FRAME):
            columns[name] = pa.array([path] * size)
        elif name == ROW:
            # Unique and ascending in the file without counting earlier batches.
            columns[name] = pa.array(range(index << 32, (index << 32) + size), kind)
        else:
            columns[name] = pa.nulls(size, kind)
    return pa.record_batch(columns)


def arrow_types(schema: StructType) -> dict[str, pa.DataType]:
    return {f.name: ARROW_TYPES[f.dataType.simpleString()] for f in schema}


class ArrowReader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str], counts: dict[str, int], batches: int):
        self.schema = schema
        self.paths = paths
        self.counts = counts
        self.batches = batches

    def partitions(self) -> list[Batches]:
        found = []
        for path in self.paths:
            count = self.counts[path]
            found += [
                Batches(path, first, min(first + self.batches, count))
                for first in range(0, count, self.batches)
            ]
        return found

    def read(self, partition: Batches | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no batch
            return
        types = arrow_types(self.schema)
        with pa.memory_map(partition.path) as file:
            reader = pa.ipc.open_file(file)
            for index in range(partition.first, partition.last):
                yield frame_batch(reader.get_batch(index), partition.path, index, types)


class ArrowWriter(DataSourceArrowWriter):
    """Tasks write files into a staging folder; the driver moves those of finished tasks.

    Until all tasks have ended, nothing can be seen under the target. What failed or
    repeated attempts leave is deleted with the staging folder, which the driver makes and
    tasks do not. The folder must be one that tasks and driver reach through ``pyarrow.fs``: a mounted one, or HDFS, S3, GCS.
    """

    def __init__(self, path: str, overwrite: bool, by: str | None):
        self.path, self.overwrite, self.by = path, overwrite, by
        self.run = uuid.uuid4().hex
        self.staging = f"_staging-{self.run}"

    def _store(self) -> tuple[pafs.FileSystem, str]:
        local = re.sub(r"^file:/+", "/", self.path)
        store, folder = pafs.FileSystem.from_uri(local)
        return store, folder.rstrip("/")

    def prepare(self) -> "ArrowWriter":
        store, folder = self._store()
        store.create_dir(f"{folder}/{self.staging}", recursive=True)
        return self

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = self._store()
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, writer, sink, current, n = [], None, None, None, 0
        try:
            for batch in iterator:
                for value, rows in self._pieces(batch):
                    if writer is None or value != current:
                        if writer is not None:
                            writer.close()
                            sink.close()
                        inside = "" if self.by is None else f"{self.by}={value}/"
                        name = f"{inside}part-{part:05d}-{len(files):03d}-{self.run}.arrow"
                        # Opening fails once the folder is deleted, so a task that goes on after that leaves nothing.
                        staged = f"{folder}/{self.staging}/{attempt}-{len(files):03d}"
                        sink = store.open_output_stream(staged)
                        writer = pa.ipc.new_file(sink, rows.schema, options=LZ4)
                        files.append((staged, f"{folder}/{name}"))
                        current = value
                    writer.write_batch(rows)
                    n += rows.num_rows
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Written(files, n)

    def _pieces(self, batch: pa.RecordBatch) -> Iterator[tuple[str | None, pa.RecordBatch]]:
        """Runs of rows for one file each; with ``by``, rows come in the order of that column."""
        if batch.num_rows == 0 or self.by is None:
            yield from [(None, batch)] if batch.num_rows else []
            return
        at = batch.schema.names.index(self.by)
        values, rest = batch.column(at), batch.drop_columns([self.by])
        runs = pc.run_end_encode(values)
        start = 0
        for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            yield value, rest.slice(start, end - start)
            start = end

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = self._store()
        old = [f.path for f in _arrow_files(store, folder)] if self.overwrite else []
        for message in messages:
            for staged, final in message.files if message else []:
                store.create_dir(final.rsplit("/", 1)[0], recursive=True)
                store.move(staged, final)
        for path in old:
            store.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = self._store()
        staging = f"{folder}/{self.staging}"
        for last in (False, False, False, False, True):
            try:
                if store.get_file_info(staging).type == pafs.FileType.Directory:
                    store.delete_dir(staging)
                return
            except OSError:  # a task that has not ended yet opened a file in it
                if last:
                    raise
                time.sleep(0.2)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]
    rows: int


def _arrow_files(store: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    chosen = pafs.FileSelector(folder, recursive=True, allow_not_found=True)
    return [
        f for f in store.get_file_info(chosen)
        if f.path.endswith(".arrow") and "/_staging-" not in f.path[len(folder) :]
    ]


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        """All columns of all files, by name, as ``footers`` found them."""
        return frame_schema(json.loads(self.options["columns"]))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowWriter(self.options["path"], overwrite, self.options.get("by")).prepare()

    def reader(self, schema: StructType) -> DataSourceReader:
        batches = int(self.options.get("batchesPerPartition", 16))
        return ArrowReader(
            schema, json.loads(self.options["paths"]), json.loads(self.options["counts"]), batches
        )


def frame_schema(columns: dict[str, str]) -> str:
    added = {SOURCE: "string", ROW: "bigint", FRAME: "string"}
    return ", ".join(f"`{name}` {kind}" for name, kind in (columns | {c: t for c, t in added.items() if c not in columns}).items())


def read_arrow(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Frames of Arrow files in any store, one per file, united by column name.

    Rows that were saved with their file, frame and place keep them.
    """
    spark.dataSource.register(ArrowFiles)
    local, stored = split_by_reach(spark, paths)
    columns, counts = footers(spark, local, stored)
    known = {"paths": json.dumps(local), "columns": json.dumps(columns), "counts": json.dumps(counts)}
    df = spark.read.format(FORMAT).options(**known, **options).load()
    if stored:
        types = arrow_types(df.schema)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for path, reader in _open_all(batches):
                for index in range(reader.num_record_batches):
                    yield frame_batch(reader.get_batch(index), path, index, types)

        df = df.unionByName(contents(spark, stored).mapInArrow(read, df.schema))
    return nan_to_null(df)


def read_arrow_folder(spark: SparkSession, path: str, **options) -> DataFrame:
    """The Arrow files below a folder, as ``sinks.save`` writes them."""
    root = qualified(spark, path)
    found = listing(spark, path).where(F.col("path").endswith(".arrow")).orderBy("path").collect()
    return read_arrow(spark, [path.rstrip("/") + r["path"][len(root) :] for r in found], **options)


def read_parquet_frames(spark: SparkSession, *paths: str, tolerant: bool = False) -> DataFrame:
    """Saved datasets, united by column name; a dataset without frames is one per file.

    Rows saved without ``_row`` are numbered by their place in their file, which becomes ``_part``.

    ``tolerant`` passes over files that cannot be read.
    """
    options = {"mergeSchema": "true", "ignoreCorruptFiles": str(tolerant).lower()}
    df = spark.read.options(**options).parquet(*paths)
    if FRAME not in df.columns:
        df = df.withColumn(FRAME, F.col("_metadata.file_path"))
    if ROW not in df.columns:
        df = df.withColumn(ROW, F.col("_metadata.row_index"))
        if PART not in df.columns:
            df = df.withColumn(PART, F.col("_metadata.file_path"))
    return nan_to_null(df)

