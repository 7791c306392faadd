"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Times are compared as UTC microseconds. A join is broadcast only once the size
# of the small side is known (``broadcast_if_small``, or the optimizer's own
# threshold); all others are shuffle joins whose oversized partitions are split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins on several columns of tables that are in buckets of one move rows, unless an operator says otherwise.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Groups with texts or lists that a task aggregates in memory before it sorts them.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
}
# Bytes of a batch of rows on its way to Python, about, where an operator wants small ones.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of a table's rows up to which the optimizer may guess whether to broadcast it.
BROADCAST_BYTES = 16 << 20


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of some ``BATCH_BYTES`` in jobs that run meanwhile.

    A batch has 10,000 rows else, however long: the JVM and the Python worker both hold it, and
    the worker, which serves later stages too, gives little of it back.
    """
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data: ``spark.checkpoint.dir``, or one made up for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="siglake-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The optimizer then plans with the table's real size in bytes, and broadcasts it
    only below its own threshold.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/siglake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Steps:
    """Tables between the steps of an operator, in a folder of its own below the shared one.

    ``remove`` deletes those that no later result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def buckets(self, times: int) -> int:
        """``times`` as many as shuffle partitions."""
        return times * int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def write_buckets(self, df: DataFrame, name: str, key: str, times: int = 1) -> DataFrame:
        """Write ``df`` in buckets of a column, so that grouping and joining by it moves no row.

        Rows do not move for this either: they have to come from such buckets, or from
        ``repartition(self.buckets(times), key)``.
        """
        table = f"steps_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets(times), key).option("path", f"{self.folder}/{name}").saveAsTable(table)
        return self.spark.table(table)

    def remove(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.folder}/{name}")


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Settle a derived table, and let joins broadcast it if it has few bytes.

    For one row per group, file or category, joined to all rows: the optimizer
    only learns that such a table is small after it has shuffled the other side.
    Once it is written, the optimizer compares its bytes with its own threshold.
    """
    if any(kind == "void" for _, kind in df.dtypes):
        return checkpointed(df)
    return written(df)


def not_broadcast_if_large(df: DataFrame) -> DataFrame:
    """Keep the optimizer from broadcasting a table whose size it may underrate.

    It guesses the size from the columns of the files below, which says nothing of rows
    that are made from one (``inline``) or of texts. One job counts the bytes instead.
    """
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    row = sum(texts, F.lit(8 * len(df.columns)))
    held = df.agg(F.sum(row)).first()[0] or 0
    return df.hint("merge") if held > BROADCAST_BYTES else df


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, in any store that Spark reads."""
    folder, store = _folder(spark, path)
    return store.getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark writes."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)
