"""Files in any store that Spark reads: listing, and whole files as bytes.

A path is local if all tasks can open it as a file, which holds for ``file:`` and for
paths without a scheme unless the default file system is another one. All other paths
are read by Spark, one file in one piece.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEME = re.compile(r"([a-zA-Z][a-zA-Z0-9+.\-]*):(?=/)")
_GLOB = re.compile(r"([\\*?\[\]{}])")
# Largest file that is read in one piece; a task holds it in memory.
MAX_BYTES = 512 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its store, as Spark reports it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(folder).toString()


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as a local file's; None if only Spark can open it."""
    scheme = _SCHEME.match(path)
    if scheme is None:
        return path if _default_scheme(spark) == "file" else None
    return re.sub(r"^/+", "/", path[scheme.end() :]) if scheme.group(1) == "file" else None


def _default_scheme(spark: SparkSession) -> str:
    store = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem
    return store.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()


def split_by_reach(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """Paths that every task can open, and those that only Spark can."""
    found = [(path, local_path(spark, path)) for path in paths]
    return [near for _, near in found if near is not None], [path for path, near in found if near is None]


def _read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    plain = [_GLOB.sub(r"\\\1", path) for path in paths]
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(plain)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of all files below a folder; of none if there is no such folder.

    Spark lists large trees in tasks. Names that start with ``.`` or ``_`` are passed over.
    """
    try:
        return _read(spark, [root]).select("path", "length", "modificationTime")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")


def contents(spark: SparkSession, paths: Sequence[str], max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, content, error) of each file, ``path`` as it was given.

    A missing file, and one of more than ``max_bytes``, has an error instead of its bytes.
    """
    given = {qualified(spark, path): path for path in paths}
    present = {name: path for name, path in given.items() if _exists(spark, path)}
    names = F.create_map(*[F.lit(x) for pair in given.items() for x in pair]) if given else None
    schema = "path string, content binary, error string"
    absent = [(path, None, "no such file") for name, path in given.items() if name not in present]
    found = spark.createDataFrame(absent, schema)
    if not present:
        return found
    files = _read(spark, list(present.values()))
    path = F.element_at(names, F.col("path")).alias("path")
    whole = files.where(F.col("length") <= max_bytes).select(path, "content", F.lit(None).cast("string").alias("error"))
    size = F.concat(F.col("length").cast("string"), F.lit(f" bytes are more than the {max_bytes} that are read in one piece"))
    large = files.where(F.col("length") > max_bytes).select(path, F.lit(None).cast("binary").alias("content"), size.alias("error"))
    return whole.unionByName(large).unionByName(found)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
