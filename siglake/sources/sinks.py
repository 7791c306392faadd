"""Saving datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siglake.model import FRAME, PART, ROW, SOURCE
from siglake.operators.columns import convert_columns
from siglake.session import remove
from siglake.sources.arrow_files import FORMAT, ArrowFiles

FORMATS = ("parquet", "json", "arrow")


def output_name(path: Column, root: str = "", aliases: Sequence[str] = ()) -> Column:
    """Name of a frame's output: path below the root and the aliases, joined by ``_``.

    The path stays one folder name of its own: ``/``, ``=`` and ``%`` are percent-encoded.
    """
    root = root.rstrip("/")
    inside = F.startswith(path, F.lit(root + "/")) if root else F.lit(False)
    relative = F.when(inside, F.substring(path, F.lit(len(root) + 2), F.length(path))).otherwise(path)
    for plain, code in (("%", "%25"), ("/", "%2F"), ("=", "%3D")):
        relative = F.replace(relative, F.lit(plain), F.lit(code))
    return F.concat_ws("_", relative, *[F.lit(a) for a in aliases])


def save(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    separate: bool = False,
    common_root: str = "",
    aliases: Sequence[str] = (),
    categorical: Sequence[str] = (),
    numerical: Sequence[str] | dict[str, str] = (),
    raw: bool = False,
    mode: str = "overwrite",
) -> bool:
    """Write a dataset, as a whole or one folder per frame; whether it had a row.

    ``arrow`` writes Feather files (Arrow, lz4), ``read_arrow_folder`` reads them back; with
    ``separate``, a frame's rows lie in their order in its files. Of an empty dataset nothing is left. Rows are counted while they are written. For
    separate folders, rows are first gathered by frame, a large frame in several tasks.
    ``raw`` writes group results as they are, without converting columns.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unknown file format {file_format!r}")
    if not raw:
        df = convert_columns(df, categorical, numerical)
    writer_options = {"compression": "lz4"} if file_format == "parquet" else {}
    if separate:
        frame = SOURCE if SOURCE in df.columns else FRAME
        df = df.withColumn("output", output_name(F.col(frame), common_root, aliases))
        df = df.hint("rebalance", "output")
    written = Observation()
    if file_format == "arrow":
        df.sparkSession.dataSource.register(ArrowFiles)
        order = [c for c in (FRAME, PART, ROW) if c in df.columns]
        by = {"by": "output"} if separate else {}
        rows = df.sortWithinPartitions("output", *order) if separate else df
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        rows.write.format(FORMAT).mode(mode).options(path=path, **by).save()
    else:
        writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write
        if separate:
            writer = writer.partitionBy("output")
        writer.mode(mode).options(**writer_options).format(file_format).save(path)
    if written.get["rows"]:
        return True
    remove(df.sparkSession, path)
    return False
