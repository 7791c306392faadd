"""Order statistics over groups of any size.

A group may hold a third of all rows, so no group is ever ordered as a whole by
one task. Values are cut into slices at approximate quantiles of the *whole*
column. A slice holds only its share of all rows, hence so does the part of any
one group inside it: each part is ordered on its own, and the parts are
chained by adding up the sizes of the slices before them. There are as many slices
as the rows need. The cut points only steer the balance; results are exact.

Inputs that fit into one slice skip all of that, with the same results: missing
numbers (NULL and NaN) have no rank among values, infinite ones do; where rows are
numbered, NULL comes first and NaN last.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglake.session import broadcast_if_small, checkpointed

ROWS_PER_SLICE = 4_000_000
# Values a sketch keeps on each of its levels; its quantiles are off by about a thousandth.
SKETCH_SIZE = 4096


def present(x: str) -> Column:
    """The number in column ``x``; NULL for a missing one."""
    value = F.col(x).cast("double")
    return F.when(~F.isnan(value), value)


def slice_cuts(df: DataFrame, x: str, rows_per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Cut points of the column, empty if it fits into one slice.

    One pass counts the values and merges a sketch of their quantiles from all tasks. A
    cut is off by about a thousandth of all rows, and what reaches the driver is the
    sketch, some 100 KB whatever the size of the input.
    """
    finite = F.when(F.abs(present(x)) < math.inf, present(x))
    stats = df.agg(
        F.count(present(x)).alias("n"), F.count(finite).alias("finite"), F.kll_sketch_agg_double(finite, SKETCH_SIZE).alias("sketch")
    ).first()
    wanted = math.ceil(stats["n"] / rows_per_slice)
    if wanted <= 1 or not stats["finite"]:
        return []
    shares = F.lit([i / wanted for i in range(1, wanted)])
    told = df.sparkSession.range(1).select(F.kll_sketch_get_quantile_double(F.lit(bytes(stats["sketch"])), shares).alias("cuts"))
    return sorted(set(told.first()["cuts"]))


def with_slice(df: DataFrame, x: str, cuts: Sequence[float]) -> DataFrame:
    """``_slice`` in the order of ``x``: NULL in one before all others, NaN in one after."""
    bucketizer = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="_x", outputCol="_slice", handleInvalid="keep"
    )
    sliced = bucketizer.transform(df.withColumn("_x", F.col(x).cast("double")))
    place = F.when(F.col("_x").isNull(), F.lit(-1)).otherwise(F.col("_slice").cast("int"))
    return sliced.withColumn("_slice", place).drop("_x")


def slice_offsets(sliced: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """Per group and slice: rows in earlier slices (``_before``) and in the group (``total``)."""
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.groupBy(*keys, "_slice")
        .agg(size.alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("_size").over(group))
    )


def cumulative_counts(
    df: DataFrame, keys: Sequence[str], x: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Per group and distinct value: ``n`` rows, ``cumulative`` rows up to it, ``total`` rows."""
    keys = list(keys)
    rows = df.where(present(x).isNotNull()).select(*keys, x)
    counts = rows.groupBy(*keys, x).agg(F.count(F.lit(1)).alias("n"))
    cuts = slice_cuts(rows, x, rows_per_slice)
    up_to = (Window.unboundedPreceding, Window.currentRow)
    if not cuts:
        group = Window.partitionBy(*keys)
        return counts.select(
            *keys, x, "n",
            F.sum("n").over(group.orderBy(x).rowsBetween(*up_to)).alias("cumulative"),
            F.sum("n").over(group).alias("total"),
        )
    sliced = with_slice(counts, x, cuts)
    offsets = slice_offsets(sliced, keys, F.sum("n")).drop("_size")
    part = Window.partitionBy(*keys, "_slice").orderBy(x).rowsBetween(*up_to)
    return (
        sliced.withColumn("_inside", F.sum("n").over(part))
        .join(offsets, [*keys, "_slice"])
        .select(*keys, x, "n", (F.col("_before") + F.col("_inside")).alias("cumulative"), "total")
    )


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    probabilities: Sequence[float],
    rows_per_slice: int = ROWS_PER_SLICE,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Exact quantiles (linear interpolation) per group: ``n`` and the array ``q``.

    ``cuts`` are those of ``slice_cuts``, if they are known.

    On large input the sizes of all slices are counted first. They tell which
    slices hold a wanted rank, and only the rows of those are shuffled and ordered.
    """
    keys = list(keys)
    rows = df.where(present(x).isNotNull()).select(*keys, F.col(x).cast("double").alias(x))
    cuts = slice_cuts(rows, x, rows_per_slice) if cuts is None else cuts
    if not cuts:
        # The exact percentile keeps a group's distinct values, at most one slice of rows here.
        probs = F.array(*[F.lit(float(p)) for p in probabilities])
        return rows.groupBy(*keys).agg(F.count(x).alias("n"), F.percentile(x, probs).alias("q"))

    ranks = [p * (F.col("total") - 1) for p in probabilities]  # from 0, fractional
    needed = F.array(*[F.floor(r) for r in ranks], *[F.ceil(r) for r in ranks])
    inside = lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_size"))
    sliced = with_slice(rows, x, cuts)
    offsets = slice_offsets(sliced, keys, F.count(F.lit(1)))
    wanted = broadcast_if_small(offsets.where(F.exists(needed, inside)))
    values = (
        sliced.join(wanted, [*keys, "_slice"])
        .groupBy(*keys, "_slice", "_before", "total", x)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    part = Window.partitionBy(*keys, "_slice").orderBy(x)
    end = F.col("_before") + F.sum("_n").over(
        part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    values = values.withColumn("_end", end)

    def at(rank: Column) -> Column:
        covers = (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))
        return F.max(F.when(covers, F.col(x)))

    picked = values.groupBy(*keys).agg(
        F.max("total").alias("n"),
        *[at(F.floor(r)).alias(f"_lo{i}") for i, r in enumerate(ranks)],
        *[at(F.ceil(r)).alias(f"_hi{i}") for i, r in enumerate(ranks)],
    )
    quantiles = []
    for i, p in enumerate(probabilities):
        rank = p * (F.col("n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = low + (high - low) * (rank - F.floor(rank))
        quantiles.append(F.when(low == high, low).otherwise(between))  # also of infinite values
    return picked.select(*keys, "n", F.array(*quantiles).alias("q"))


def row_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the rows of each group from 0 by the numeric, unique column ``x``."""
    keys = list(keys)
    cuts = slice_cuts(df, x, rows_per_slice)
    if not cuts:
        position = F.row_number().over(Window.partitionBy(*keys).orderBy(x)).cast("bigint") - 1
        return df.withColumn(name, position)
    sliced = with_slice(df, x, cuts)
    offsets = slice_offsets(sliced, keys, F.count(F.lit(1))).drop("_size", "total")
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(x)) - 1
    return (
        sliced.withColumn("_inside", inside)
        .join(offsets, [*keys, "_slice"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .select(*df.columns, name)
    )


def global_ordinal(
    df: DataFrame, order: Sequence[Column], name: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Number all rows from 0 by a sort key of any type.

    Large input is range partitioned. The partitioning is written to the
    checkpoint folder, since sizes and positions must come from the same one.
    """
    n = df.count()
    if n <= rows_per_slice:
        position = F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1
        return df.withColumn(name, position)
    ranges = df.repartitionByRange(math.ceil(n / rows_per_slice), *order)
    sliced = checkpointed(ranges.withColumn("_slice", F.spark_partition_id()))
    offsets = slice_offsets(sliced, [], F.count(F.lit(1))).select("_slice", "_before")
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order)) - 1
    return (
        sliced.withColumn("_inside", inside)
        .join(offsets, "_slice")
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .select(*df.columns, name)
    )
