"""Merging datasets frame by frame, and attaching per-file columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.model import FRAME, PART, ROW, SOURCE
from siglake.operators.ranking import ROWS_PER_SLICE, global_ordinal
from siglake.session import broadcast_if_small

RIGHT_SUFFIX = "_r"
BOOKKEEPING = (FRAME, PART, ROW)


def merge_rows(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    drop_right: Sequence[str] = (),
) -> DataFrame:
    """Inner join; a missing key matches a missing key.

    Columns present on both sides get the suffix ``_r`` on the right. Equally
    named keys appear once. ``drop_right`` lists join keys not to keep.
    """
    same = [l for l, r in zip(left_keys, right_keys) if l == r]
    hidden = {c: f"_right_{c}" for c in right.columns}
    renamed = right.select([F.col(c).alias(hidden[c]) for c in right.columns])
    condition = reduce(
        lambda a, b: a & b,
        [F.col(l).eqNullSafe(F.col(hidden[r])) for l, r in zip(left_keys, right_keys)],
    )
    kept = []
    for column in right.columns:
        if column in same or column in drop_right:
            continue
        name = f"{column}{RIGHT_SUFFIX}" if column in left.columns else column
        kept.append(F.col(hidden[column]).alias(name))
    return left.join(renamed, condition).select(*left.columns, *kept)


def merge_by_attribute(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str] | None = None,
    right_keys: Sequence[str] | None = None,
    attribute: str = SOURCE,
) -> DataFrame:
    """Merge the rows of frames that share an attribute, by default the source file.

    Without keys the rows are joined on all columns the two sides share. The
    result keeps frame and row of the left side.
    """
    right = right.drop(*[c for c in BOOKKEEPING if c != attribute])
    left_keys, right_keys = _row_keys(left, right, left_keys, right_keys, attribute)
    return merge_rows(left, right, [attribute, *left_keys], [attribute, *right_keys])


def merge_by_files(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str] | None = None,
    right_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Merge the rows of two frames whose rows come from the same set of files.

    Unlike ``merge_by_attribute``, rows of different files meet if their keys are equal,
    as in two concatenations of the same files. Each set of files has to belong to one
    frame on either side. Frames are told apart by a hash of their set of files.
    """
    sets = [
        broadcast_if_small(
            df.select(FRAME, SOURCE)
            .distinct()
            .groupBy(FRAME)
            .agg(F.bit_xor(F.xxhash64(SOURCE)).alias("files"), F.count(F.lit(1)).alias("n"))
        )
        for df in (left, right)
    ]
    for side in sets:
        if not side.groupBy("files", "n").count().where("count > 1").isEmpty():
            raise ValueError("several frames have the same set of files")
    pairs = sets[0].join(sets[1].withColumnRenamed(FRAME, "_theirs"), ["files", "n"])
    pairs = broadcast_if_small(pairs.select(FRAME, "_theirs"))
    paired = left.join(pairs, FRAME).select(*left.columns, "_theirs")
    others = right.withColumn("_theirs", F.col(FRAME)).drop(*BOOKKEEPING)
    left_keys, right_keys = _row_keys(
        left.drop(SOURCE), right.drop(*BOOKKEEPING, SOURCE), left_keys, right_keys, SOURCE
    )
    merged = merge_rows(paired, others, ["_theirs", *left_keys], ["_theirs", *right_keys])
    return merged.drop("_theirs")


def merge_by_position(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str] | None = None,
    right_keys: Sequence[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Merge the n-th frame of the left with the n-th of the right; surplus frames are left out."""

    def numbered(df: DataFrame) -> DataFrame:
        frames = df.select(FRAME).distinct()
        numbers = global_ordinal(frames, [F.col(FRAME)], "_nth", rows_per_slice)
        return df.join(broadcast_if_small(numbers), FRAME)

    left, right = numbered(left), numbered(right).drop(*BOOKKEEPING)
    left_keys, right_keys = _row_keys(left, right, left_keys, right_keys, "_nth")
    return merge_rows(left, right, ["_nth", *left_keys], ["_nth", *right_keys]).drop("_nth")


def natural_merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """Merge per file on every column the two sides share."""
    return merge_by_attribute(left, right)


def _row_keys(left, right, left_keys, right_keys, pairing):
    if left_keys is None and right_keys is None:
        metadata = (pairing, SOURCE, *BOOKKEEPING)
        shared = [c for c in left.columns if c in right.columns and c not in metadata]
        if not shared:
            raise ValueError("the datasets share no column to merge on")
        return shared, shared
    left_keys, right_keys = list(left_keys or right_keys), list(right_keys or left_keys)
    return left_keys, right_keys


def join_per_file(facts: DataFrame, per_file: DataFrame) -> DataFrame:
    """Pair each row with the rows of a per-file table of the same file.

    Stands for a join without condition inside one result file.
    """
    per_file = per_file.drop(*[c for c in BOOKKEEPING if c in facts.columns])
    return facts.join(per_file, SOURCE)
