"""Comparing datasets cell by cell."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.model import FRAME, PART, ROW
from siglake.operators.ranking import ROWS_PER_SLICE, row_ordinal

ORDINAL = "_ordinal"


def with_ordinal(df: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Number the rows of each frame (or piece of one) from 0, to pair rows by position."""
    keys = [c for c in (FRAME, PART) if c in df.columns]
    return row_ordinal(df, keys, ROW, ORDINAL, rows_per_slice)


def _paired(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        cells = F.struct(*columns).alias(name)
        return df.select(*on, cells)

    return side(left, "_left").join(side(right, "_right"), list(on), "full")


def _compared(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[str]:
    skipped = {*on, FRAME, PART, ROW, ORDINAL}
    columns = [c for c in left.columns if c not in skipped]
    if set(columns) != {c for c in right.columns if c not in skipped}:
        raise ValueError("can only compare datasets with the same columns")
    return columns


def frames_equal(
    datasets: Sequence[DataFrame], on: Sequence[str] = (FRAME, ROW)
) -> DataFrame:
    """One row per pair of consecutive datasets: are all cells equal? A missing cell never is."""
    results = []
    for number, (left, right) in enumerate(zip(datasets, datasets[1:])):
        columns = _compared(left, right, on)
        same = reduce(
            lambda a, b: a & b,
            [F.coalesce(F.col(f"_left.{c}") == F.col(f"_right.{c}"), F.lit(False)) for c in columns],
            F.col("_left").isNotNull() & F.col("_right").isNotNull(),
        )
        results.append(
            _paired(left, right, on, columns).agg(
                F.lit(number).alias("pair"),
                F.coalesce(F.every(same), F.lit(True)).alias("equal"),
            )
        )
    return reduce(DataFrame.unionByName, results)


def frames_diff(
    left: DataFrame, right: DataFrame, on: Sequence[str] = (FRAME, ROW)
) -> DataFrame:
    """The differing cells as (``column``, ``self``, ``other``) texts; missing equals missing."""
    columns = _compared(left, right, on)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_left.{c}").cast("string").alias("self"),
                F.col(f"_right.{c}").cast("string").alias("other"),
                (~F.col(f"_left.{c}").eqNullSafe(F.col(f"_right.{c}"))).alias("differs"),
            )
            for c in columns
        ]
    )
    cell = F.explode(F.filter(cells, lambda c: c["differs"])).alias("cell")
    paired = _paired(left, right, on, columns)
    return paired.select(*on, cell).select(*on, "cell.column", "cell.self", "cell.other")


def rows_differ(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows with more copies on one side, regardless of order: the ``side`` and ``n`` surplus copies."""
    columns = left.columns
    surplus = (
        left.withColumn("_copies", F.lit(1))
        .unionByName(right.select(*columns).withColumn("_copies", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("_copies").alias("_copies"))
        .where(F.col("_copies") != 0)
    )
    side = F.when(F.col("_copies") > 0, "left").otherwise("right")
    return surplus.select(*columns, side.alias("side"), F.abs("_copies").alias("n"))
