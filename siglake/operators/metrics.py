"""Measures of communication quality, and the small reshaping steps around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.functions import numbers
from siglake.functions.text import Pattern, field
from siglake.model import group_keys, row_order
from siglake.operators.frames import apply_groups

PICOSECONDS_TO_MS = 1e-9


def update_interval(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str = "update_interval",
    time: str = "simtimeRaw",
    across_frames: bool = False,
) -> DataFrame:
    """Mean time between consecutive samples of a group; NULL for a single one.

    The differences of sorted times add up to the span, so no times are sorted.
    """
    span = F.max(time) - F.min(time)
    gaps = F.count(time) - 1
    mean = lambda: F.when(gaps > 0, span / gaps).cast("double")
    return apply_groups(df, keys, input_column, output_column, mean, across_frames)


def age_of_information(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str = "mean_aoi",
    time: str = "simtimeRaw",
    variable: str = "variable",
    to_ms: float = PICOSECONDS_TO_MS,
    across_frames: bool = False,
) -> DataFrame:
    """Sum of the values over the time from the message's generation to its last sample.

    The generation time (ms) is the last field of the first sample's variable.
    NULL where no time has passed; missing values add nothing.
    """

    def mean() -> Column:
        same = variable in group_keys(keys, across_frames)  # all samples of a group have one
        first = F.col(variable) if same else F.min_by(variable, F.struct(time, row_order(df)))
        generated = numbers.to_long(field(first, "_", -1))
        elapsed = F.max(time) * F.lit(to_ms) - generated
        return F.when(elapsed != 0, F.coalesce(F.sum(F.col(input_column).cast("double")), F.lit(0.0)) / elapsed)

    return apply_groups(df, keys, input_column, output_column, mean, across_frames)


def sum_over_count(
    df: DataFrame,
    keys: Sequence[str],
    input_column: str,
    output_column: str,
    kind: str = "type",
    across_frames: bool = False,
) -> DataFrame:
    """The value of kind ``sum`` over that of kind ``count``; NULL unless the group is that pair."""

    def mean() -> Column:
        pick = lambda name: F.max(F.when(F.col(kind) == name, F.col(input_column)))
        return F.when(F.count(F.lit(1)) == 2, F.try_divide(pick("sum"), pick("count")))

    return apply_groups(df, keys, input_column, output_column, mean, across_frames)


def complement(column: Column) -> Column:
    return F.lit(1.0) - column


def path_features(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """One column per named group of the pattern, read from a path."""
    return df.withColumns(Pattern(pattern).columns(F.col(column)))


def time_bucket(df: DataFrame, output_column: str, time: str = "simtimeRaw", **scale) -> DataFrame:
    return df.withColumn(output_column, numbers.time_bucket(F.col(time), **scale))


def last_field(column: Column, separator: str = "_") -> Column:
    return F.substring_index(column, separator, -1)


def numbered_field(column: Column, index: int, separator: str = "_") -> Column:
    """A field of a separated name as a whole number."""
    return numbers.to_long(field(column, separator, index))


def relabel(column: Column, marker: str, otherwise: str) -> Column:
    """The marker where the text contains it, else the other label."""
    return F.when(column.contains(marker), F.lit(marker)).otherwise(F.lit(otherwise))
