"""Further layouts of the ingested signals, for joins by event and for areas.

* Events: all signals in buckets of (file, event). Joins on these columns start from the
  buckets, so no row moves, however many joins follow.
* Positions: the pairs of an x and a y signal, ordered along a Z-curve. A rectangle is a few
  stretches of the curve, and Parquet passes over the row groups of all others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.model import SOURCE
from siglake.operators.query import positions
from siglake.session import remove, stored_bytes

EVENT = (SOURCE, "eventNumber")
# Stored bytes of the signals for each bucket.
BUCKET_BYTES = 256 << 20
# Rows that a task orders along the Z-curve. Stored, they can take a twentieth of what they take in memory.
ROWS_PER_PART = 1_000_000
# Cells of the Z-curve along either axis, a power of two.
CELLS = 256


def _table_name(path: str) -> str:
    return "events_" + hashlib.md5(path.encode()).hexdigest()


def write_events(signals: DataFrame, path: str, buckets: int | None = None, stored: int = 0) -> DataFrame:
    """Write ``signals`` in buckets of (file, event), inside each by name; the table to join from.

    There are as many buckets as ``stored`` bytes need, 8 at least. An event's rows lie in
    one bucket; a file, however large, is spread over all.
    """
    spark = signals.sparkSession
    buckets = buckets or max(8, math.ceil(stored / BUCKET_BYTES))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove(spark, path)
    (
        signals.repartition(buckets, *EVENT)
        .write.bucketBy(buckets, *EVENT)
        .sortBy("vectorName", *EVENT)
        .option("path", f"{path}/{buckets}")
        .saveAsTable(name)
    )
    return spark.table(name)


def open_events(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that ``write_events`` wrote, also in a later session; None if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return None
    (buckets,) = [int(s.getPath().getName()) for s in store.listStatus(folder) if s.getPath().getName().isdigit()]
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{n}` {t}" for n, t in spark.read.parquet(f"{path}/{buckets}").dtypes)
        keys = ", ".join(f"`{k}`" for k in EVENT)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({keys}) SORTED BY (`vectorName`, {keys}) INTO {buckets} BUCKETS LOCATION '{path}/{buckets}'"
        )
    return spark.table(name)


def z_order(x: Column, y: Column, bits: int) -> Column:
    """The bits of two whole numbers in turn: near cells get near numbers."""
    parts = [
        F.shiftleft(F.shiftright(value, bit).bitwiseAND(1), 2 * bit + odd) for bit in range(bits) for odd, value in ((0, x), (1, y))
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _cells(df: DataFrame, columns: Sequence[str], cells: int) -> DataFrame:
    """``_cell_<column>``: the column's place among its quantiles; NULL and NaN in a cell of their own."""
    share = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    cuts = df.agg(*[F.percentile_approx(F.nanvl(F.col(c), F.lit(None)), share, 10 * cells).alias(c) for c in columns]).first()
    for c in columns:
        inner = sorted({v for v in cuts[c] or [] if math.isfinite(v)}) or [0.0]
        splits = [-math.inf, *inner, math.inf]
        bucketizer = Bucketizer(splits=splits, inputCol="_x", outputCol="_y", handleInvalid="keep")
        placed = bucketizer.transform(df.withColumn("_x", F.col(c).cast("double")))
        df = placed.withColumn(f"_cell_{c}", F.col("_y").cast("int")).drop("_x", "_y")
    return df


def write_positions(
    signals: DataFrame,
    x_signal: str,
    y_signal: str,
    path: str,
    x_alias: str = "posX",
    y_alias: str = "posY",
    parts: int | None = None,
    cells: int = CELLS,
) -> DataFrame:
    """Write the pairs of ``query.positions``, ordered along a Z-curve over quantiles of x and y.

    The cells follow the data, so that a crowded area is cut as finely as its rows need.
    Without ``parts`` a task orders at most about ``ROWS_PER_PART`` rows and ``BUCKET_BYTES``.
    """
    spark = signals.sparkSession
    pairs = f"{path}/_pairs"
    positions(signals, x_signal, y_signal, x_alias, y_alias).write.mode("overwrite").parquet(pairs)
    rows = spark.read.schema(positions(signals, x_signal, y_signal, x_alias, y_alias).schema).parquet(pairs)
    parts = parts or max(1, math.ceil(stored_bytes(spark, pairs) / BUCKET_BYTES), math.ceil(rows.count() / ROWS_PER_PART))
    placed = _cells(rows, [x_alias, y_alias], cells)
    key = z_order(F.col(f"_cell_{x_alias}"), F.col(f"_cell_{y_alias}"), cells.bit_length()).alias("_z")
    ordered = placed.select(*rows.columns, key).repartitionByRange(parts, "_z", x_alias).sortWithinPartitions("_z", x_alias)
    ordered.drop("_z").write.mode("overwrite").parquet(f"{path}/ordered")
    remove(spark, pairs)
    return open_positions(spark, path)


def open_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ordered")


def in_area(pairs: DataFrame, area: tuple[float, float, float, float], x_alias: str = "posX", y_alias: str = "posY") -> DataFrame:
    """The pairs in (x_min, y_min, x_max, y_max), bounds included."""
    x_min, y_min, x_max, y_max = area
    return pairs.where(F.col(x_alias).between(x_min, x_max) & F.col(y_alias).between(y_min, y_max))
