"""Ingest of result files into Parquet tables, and the tables as one object."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.model import DATA_COLUMNS, ROW, SOURCE, nan_to_null
from siglake.session import broadcast_if_small, not_broadcast_if_large, remove, stored_bytes
from siglake.sources.layouts import open_events, write_events
from siglake.sources.sqlite import FORMAT, RUN_PARAMETERS, SqliteResults, unpacked, unpacked_rows
from siglake.sources.store import split_by_reach

# Column to order a written table by, so that a query by name reads few row groups.
SORTED_BY = {
    "signals": ["vectorName", SOURCE, "eventNumber"],
    "scalars": ["scalarName", SOURCE, "scalarId"],
    "statistics": ["statName", SOURCE, "statId"],
    "run_attrs": [SOURCE, ROW],
    "run_params": [SOURCE, ROW],
    "runs": [SOURCE, "runId"],
}
# Columns that are searched by value but do not lead the order: row groups without the value are skipped.
BLOOM_FILTERS = {
    "signals": {f"parquet.bloom.filter.enabled#{c}": "true" for c in ("moduleName", "eventNumber")},
    "scalars": {"parquet.bloom.filter.enabled#moduleName": "true"},
}
EVENTS = "signal_events"

# Tables of a result file.
TABLES = ("run", "runAttr", RUN_PARAMETERS, "vector", "vectorData", "scalar", "statistic")

# Stored bytes of the staged table for each sorted partition.
PARTITION_BYTES = 256 << 20


class Metadata(NamedTuple):
    rows: int
    text_bytes: int
    data_columns: list[str]  # names of data columns that some run uses as a key


@dataclass(frozen=True)
class Results:
    """The result tables of any number of files.

    ``signals`` has one row per sample with the names of its vector. Every table
    carries ``source_file`` and a ``_row`` that orders the rows of a file. ``events`` are
    the signals in buckets of file and event, if they were written so.
    """

    signals: DataFrame | None = None
    scalars: DataFrame | None = None
    statistics: DataFrame | None = None
    run_attrs: DataFrame | None = None
    run_params: DataFrame | None = None
    runs: DataFrame | None = None
    events: DataFrame | None = None

    @cached_property
    def metadata(self) -> Metadata:
        """Size of the run attributes and parameters, from one small job."""
        rows = self.run_attrs.select(
            F.col("attrName").alias("key"), F.col("attrValue").alias("text")
        ).unionByName(self.run_params.select("key", F.col("value").alias("text")))
        return Metadata(
            *rows.agg(
                F.count(F.lit(1)),
                F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                F.collect_set(F.when(F.col("key").isin(*DATA_COLUMNS), F.col("key"))),
            ).first()
        )


def read_sqlite(spark: SparkSession, paths: Sequence[str], table: str, **options) -> DataFrame:
    """One table of all files, unreadable files included (see ``ingest_error``).

    The paths may lie in any store that Spark reads. ``options`` are those of the data
    source for files that tasks can open.
    """
    local, stored = split_by_reach(spark, paths)
    spark.dataSource.register(SqliteResults)
    reader = spark.read.format(FORMAT).options(table=table, paths=json.dumps(local))
    rows = reader.options(**options).load()
    return rows.unionByName(unpacked_rows(unpacked(spark, stored, [table]), table)) if stored else rows


def join_signals(vector: DataFrame, vector_data: DataFrame) -> DataFrame:
    """Samples with module and signal name: vector joined to its data, file by file.

    A file can have millions of vectors, so both sides are shuffled unless the vectors are few.
    """
    names = not_broadcast_if_large(vector.select(SOURCE, "vectorId", "moduleName", "vectorName"))
    return vector_data.join(names, [SOURCE, "vectorId"])


def unify_parameters(run_param: DataFrame | None, run_config: DataFrame | None) -> DataFrame:
    """Run parameters of both file versions as ``key`` and ``value``."""
    tables = []
    if run_param is not None:
        tables.append(("param", run_param))
    if run_config is not None:
        tables.append(("config", run_config))
    if not tables:
        raise ValueError("neither run parameters nor run configuration given")
    unified = [
        table.select(
            SOURCE,
            ROW,
            F.col(f"{prefix}Key").alias("key"),
            F.col(f"{prefix}Value").alias("value"),
            F.col(f"{prefix}Order").alias("ord"),
        )
        for prefix, table in tables
    ]
    return unified[0] if len(unified) == 1 else unified[0].unionByName(unified[1])


def ingest(spark: SparkSession, paths: Sequence[str], target: str, by_event: bool = False, **options) -> None:
    """Write the tables of all files below ``target``.

    ``by_event`` writes the signals a second time, in buckets of file and event, from
    which positions are joined without moving a row.
    Each file is read once, into staging tables, which are removed at the end. A table
    of a file that cannot be read is listed in ``ingest_errors`` and costs only itself:
    the file's other tables stay. Samples need the file's table of signal names too.
    """
    staged = {}
    staging = f"{target}/_staging"
    local, stored = split_by_reach(spark, paths)
    files = None
    if stored:
        unpacked(spark, stored, TABLES).write.mode("overwrite").parquet(f"{staging}/files")
        files = spark.read.parquet(f"{staging}/files")
    for table in TABLES:
        folder = f"{staging}/{table}"
        rows = read_sqlite(spark, local, table, **options)
        if files is not None:
            rows = rows.unionByName(unpacked_rows(files, table))
        rows.write.mode("overwrite").parquet(folder)
        staged[table] = spark.read.parquet(folder)

    errors = None
    for table, df in staged.items():
        found = df.where(F.col("ingest_error").isNotNull()).select(
            SOURCE, F.lit(table).alias("table"), F.col("ingest_error").alias("error")
        )
        errors = found if errors is None else errors.unionByName(found)
    errors.repartition(1).write.mode("overwrite").parquet(f"{target}/ingest_errors")
    bad = spark.read.parquet(f"{target}/ingest_errors").select(SOURCE, "table").distinct()
    bad_tables = {r["table"] for r in bad.select("table").distinct().collect()}

    def rows(table: str, row: str = "rowId") -> DataFrame:
        df = staged[table].where(F.col("ingest_error").isNull()).drop("ingest_error")
        if table in bad_tables:  # a file of several parts may have failed in one
            df = df.join(bad.where(F.col("table") == table).select(SOURCE), SOURCE, "left_anti")
        return df.withColumn(ROW, F.col(row)).drop("rowId") if row in df.columns else df

    names = broadcast_if_small(rows("vector").select(SOURCE, "vectorId", "moduleName", "vectorName"))
    tables = {
        "signals": (join_signals(names, rows("vectorData")), "vectorData"),
        "scalars": (rows("scalar", "scalarId"), "scalar"),
        "statistics": (rows("statistic", "statId"), "statistic"),
        "run_attrs": (rows("runAttr"), "runAttr"),
        "run_params": (rows(RUN_PARAMETERS), RUN_PARAMETERS),
        "runs": (rows("run"), "run"),
    }
    for name, (df, source) in tables.items():
        order = SORTED_BY[name]
        parts = max(1, math.ceil(stored_bytes(spark, f"{staging}/{source}") / PARTITION_BYTES))
        ordered = nan_to_null(df).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        ordered.write.mode("overwrite").options(**BLOOM_FILTERS.get(name, {})).parquet(f"{target}/{name}")
    remove(spark, staging)
    remove(spark, f"{target}/{EVENTS}")
    if by_event:
        signals = spark.read.parquet(f"{target}/signals")
        write_events(signals, f"{target}/{EVENTS}", stored=stored_bytes(spark, f"{target}/signals"))


def load(spark: SparkSession, target: str) -> Results:
    tables = {name: spark.read.parquet(f"{target}/{name}") for name in SORTED_BY}
    return Results(**tables, events=open_events(spark, f"{target}/{EVENTS}"))


def sql_per_file(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    query: str,
    include_filename: bool = False,
) -> DataFrame:
    """Run SQL over named tables holding the rows of all files.

    Each file is a database of its own: joins in the query name ``source_file``
    among their columns, as in ``FROM flows JOIN config USING (source_file)``.
    """
    own = {
        name: spark.table(name)
        for name in tables
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
    }
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        result = spark.sql(query)
    finally:  # views of the caller come back
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in own.items():
            df.createOrReplaceTempView(name)
    result = result.drop("rowId")
    if include_filename:
        result = result.withColumn("filename", F.col(SOURCE))
    return result
