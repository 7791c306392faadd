"""Result tables, and the bookkeeping columns every dataset carries.

A dataset is one DataFrame holding any number of frames. ``_frame`` names the
frame a row belongs to (at extraction: its result file), ``_row`` gives the
row's position inside the file, and ``_part`` orders the pieces of a
concatenated frame. Grouping and merging work per frame unless asked otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAME = "_frame"
PART = "_part"
ROW = "_row"
SOURCE = "source_file"

SCHEMAS = {
    "run": "runId long, runName string, simtimeExp int",
    "runAttr": "rowId long, runId long, attrName string, attrValue string",
    "runParam": "rowId long, runId long, paramKey string, paramValue string, paramOrder int",
    "runConfig": "rowId long, runId long, configKey string, configValue string, configOrder int",
    "vector": (
        "vectorId long, runId long, moduleName string, vectorName string, vectorCount long, "
        "vectorMin double, vectorMax double, vectorSum double, vectorSumSqr double, "
        "startEventNum long, endEventNum long, startSimtimeRaw long, endSimtimeRaw long"
    ),
    "vectorData": "rowId long, vectorId long, eventNumber long, simtimeRaw long, value double",
    "scalar": "scalarId long, runId long, moduleName string, scalarName string, scalarValue double",
    "statistic": (
        "statId long, runId long, moduleName string, statName string, isHistogram long, "
        "isWeighted long, statCount long, statMean double, statStddev double, statSum double, "
        "statSqrsum double, statMin double, statMax double, statWeights double, "
        "statWeightedSum double, statSqrSumWeights double, statWeightedSqrSum double"
    ),
}

DATA_COLUMNS = sorted(
    {column.split()[0] for schema in SCHEMAS.values() for column in schema.split(", ")}
)

# Order of the columns a statistic query may select.
STATISTIC_COLUMNS = (
    "statId", "runId", "moduleName", "statName", "isHistogram", "isWeighted", "statCount",
    "statMean", "statStddev", "statSum", "statSqrsum", "statMin", "statMax", "statWeights",
    "statWeightedSum", "statSqrSumWeights", "statWeightedSqrSum",
)


def as_frames(df: DataFrame, frame: str = SOURCE, row: str | None = None) -> DataFrame:
    """Make every value of ``frame`` a frame of its own, ordered by ``row``."""
    df = df.withColumn(FRAME, F.col(frame))
    return df.withColumn(ROW, F.col(row)) if row else df


def row_order(df: DataFrame) -> Column:
    """Sort key of a row in its dataset: frame, piece, position."""
    columns = [c for c in (FRAME, PART, ROW) if c in df.columns]
    if ROW not in columns:
        raise ValueError(f"dataset has no {ROW} column to order its rows by")
    return F.struct(*columns)


def group_keys(keys: Sequence[str], across_frames: bool = False) -> list[str]:
    keys = list(keys)
    return keys if across_frames or FRAME in keys else [FRAME, *keys]


def is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers are NULL everywhere, so that aggregates skip them."""
    floats = [c for c in (columns or df.columns) if is_float(df, c)]
    if not floats:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats})


def with_keys_present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows lacking a group key belong to no group."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
        if is_float(df, key):
            df = df.where(~F.isnan(key))
    return df
