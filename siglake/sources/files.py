"""Choosing, sampling and filtering input."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siglake.functions.text import Pattern
from siglake.model import FRAME, PART, ROW, SOURCE
from siglake.session import broadcast_if_small
from siglake.sources.store import listing, qualified

# Fixed value: what counts as literal in a path pattern.
_LITERAL_RUN = re.compile(r"[a-zA-Z0-9_\-/]+")
SAMPLE_SEED = 23


# A store named at the start of a path, such as ``hdfs://host``.
_STORE = re.compile(r"[a-zA-Z][a-zA-Z0-9+.\-]*:(?://[^/]*)?(?=/)")


def static_root(pattern: str) -> str:
    """Folder above the first run of literal characters in a path pattern, with its store."""
    store = _STORE.match(pattern)
    start = store.end() if store else 0
    return pattern[:start] + str(PurePath(_LITERAL_RUN.search(pattern, start).group()).parent)


def relative_pattern(pattern: str) -> tuple[str, str]:
    root = static_root(pattern)
    store = _STORE.match(root)
    start = store.end() if store else 0
    return root, str(PurePath(pattern[start:]).relative_to(root[start:]))


def list_files(patterns: str | Sequence[str], spark: SparkSession | None = None) -> tuple[str, list[str]]:
    """Common root and the files matching each pattern in turn; a file may come up twice.

    A pattern is searched in the path below its static root, which may lie in any store
    that Spark reads. Spark lists and chooses the files; hidden ones are passed over.
    """
    spark = spark or SparkSession.active()
    single = isinstance(patterns, str)
    roots, found = [], []
    for pattern in [patterns] if single else patterns:
        root, relative = relative_pattern(pattern)
        roots.append(root)
        prefix = qualified(spark, root).rstrip("/") + "/"
        inside = F.substring(F.col("path"), len(prefix) + 1, 2**31 - 1)
        rows = listing(spark, root).where(Pattern(relative).found(inside)).select(inside.alias("name")).collect()
        found += sorted(f"{root.rstrip('/')}/{row['name']}" for row in rows)
    if not found:
        raise FileNotFoundError(f"no input files for {patterns}")
    return roots[0] if single else os.path.commonprefix(roots), found


def select_files(df: DataFrame, patterns: str | Sequence[str], path: str = SOURCE) -> DataFrame:
    """Rows of the files matching the patterns; rows come once per pattern that matches.

    The paths are relative to the folder of the first literal run of the pattern,
    so ``/data/runs/.*vec`` is searched below ``/data``.
    """
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)

    def hit(pattern: str) -> Column:
        root, relative = relative_pattern(pattern)
        found = Pattern(relative).found
        if root == ".":
            return found(F.col(path))
        prefix = root.rstrip("/") + "/"
        inside = F.col(path).startswith(prefix)
        return inside & found(F.substring(F.col(path), len(prefix) + 1, 2**31 - 1))

    if len(patterns) == 1:
        return df.where(hit(patterns[0]))
    hits = F.array(*[F.when(hit(p), F.lit(i)) for i, p in enumerate(patterns)])
    return df.withColumn("_hit", F.explode(F.array_compact(hits))).drop("_hit")


def with_source_file(df: DataFrame, column: str = SOURCE) -> DataFrame:
    """Path of the file a row was read from; only right after the scan."""
    return df.withColumn(column, F.col("_metadata.file_path"))


def _bucket_sql(fraction: float, digest: str, halvings: int = 40) -> str:
    """Buckets of a hex digest in ascending order, halving in width towards the fraction.

    Most rows are far from it, and placed by the first comparisons.
    """
    size = 2**128
    middle = min(int(fraction * size), size - 1)
    below, above = [], []
    for k in range(1, halvings + 1):
        low, high = middle - (size >> k), middle + (size >> k)
        if low >= 0:
            below.append(f"WHEN {digest} < '{low:032x}' THEN {k - 100}")
        if high < size:
            above.append(f"WHEN {digest} >= '{high:032x}' THEN {100 - k}")
    nearest = halvings + 1

    def chain(cases: list[str], rest: int) -> str:
        return f"CASE {' '.join(cases)} ELSE {rest} END" if cases else str(rest)

    left, right = chain(below, nearest - 100), chain(above, 100 - nearest)
    return f"CASE WHEN {digest} < '{middle:032x}' THEN {left} ELSE {right} END"


def sample_rows(
    df: DataFrame,
    fraction: float,
    seed: int = SAMPLE_SEED,
    exact: bool = True,
    frame: str = FRAME,
    row: str = ROW,
) -> DataFrame:
    """Sample without replacement; ``exact`` keeps round(fraction * rows) rows of each frame.

    Part and row have to tell the rows of a frame apart; rows that share them, as after a
    join that repeats rows, are drawn together. Rows are ordered by a hash, an even spread over [0, 1). The last row of the
    sample has a hash near the fraction, so buckets halve in width towards it:
    their sizes tell in which one the quota of a frame is used up, and with n rows
    that is a bucket of about the root of n. Only that bucket is ordered. Only then
    are whole rows read, and none of them is shuffled.
    """
    if not exact:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    place = [F.col(c) for c in (PART, row) if c in df.columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in place]))
    at = F.struct(*place)
    hashed = df.select(frame, at.alias("_at"), digest.alias("_digest"))
    hashed = hashed.withColumn("_bucket", F.expr(_bucket_sql(fraction, "_digest")))
    group = Window.partitionBy(frame)
    up_to = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Half-way cases go to the even number, as Python's round() does.
    quota = F.bround(F.lit(float(fraction)) * F.sum("_size").over(group)).cast("bigint")
    left = F.col("_quota") - F.col("_upto") + F.col("_size")
    cut = (
        hashed.groupBy(frame, "_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_upto", F.sum("_size").over(up_to))
        .withColumn("_quota", quota)
        .withColumn("_left", left)
        .where((F.col("_left") > 0) & (F.col("_upto") >= F.col("_quota")))
        .select(frame, "_bucket", "_left")
    )
    order = Window.partitionBy(frame).orderBy("_digest", "_at")
    last = (
        hashed.join(broadcast_if_small(cut), [frame, "_bucket"])
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_left"))
        .select(frame, F.struct("_digest", "_at").alias("_last"))
    )
    chosen = F.struct(digest.alias("_digest"), at.alias("_at")) <= F.col("_last")
    return df.join(broadcast_if_small(last), frame).where(chosen).select(*df.columns)


def sample_then_filter(
    df: DataFrame, fraction: float | None = None, condition: str | Column | None = None, **options
) -> DataFrame:
    """Read-time sampling and filtering; the filter sees the sample only."""
    if fraction:
        df = sample_rows(df, fraction, **options)
    return df if condition is None else df.where(condition)


def existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the listed columns that the dataset has."""
    return df.select([c for c in columns if c in df.columns])
