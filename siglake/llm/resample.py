"""Resampling of documents towards the distribution of a target.

Texts are hashed to a fixed number of buckets of word runs. A bucket's gain is the
logarithm of its share in the target over its share in the documents, and a text's
weight is looked up in the array of all gains. Weights take a Gumbel number derived from
the id, and the documents with the highest sums are drawn without replacement. The
cutoff is found by bisection: exact counts over the written scores, then over the ids
tied at the cutoff.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siglake.operators.ranking import slice_offsets
from siglake.session import written

# Words are digits, a-z and everything beyond ASCII; A-Z count as a-z, all else is a gap.
_FOLDED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


@dataclass(frozen=True)
class Settings:
    """buckets: word runs are hashed to so many. longest: words in the longest run.
    min_words, percent: so many of a hundred documents with that many words are drawn.
    seed: of the Gumbel numbers. cuts: thresholds counted by one job."""

    buckets: int = 10_000
    longest: int = 3
    min_words: int = 20
    percent: int = 5
    seed: int = 42
    cuts: int = 15


def run_buckets(text: bytes, settings: Settings) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each run of up to ``longest`` words."""
    words = text.translate(_FOLDED).split()
    spaced = [b" " + w for w in words]
    found, ends = [], list(map(crc32, words))
    for size in range(1, settings.longest + 1):
        found.append(np.array(ends, np.int64))
        ends = list(map(crc32, spaced[size:], ends))  # a run's CRC goes on from that of the run before its last word
    return len(words), np.concatenate(found) % settings.buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> np.ndarray:
    """How many runs of all texts fall into each bucket; one row per bucket leaves a task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    counts += np.bincount(run_buckets(text.as_py(), settings)[1], minlength=settings.buckets)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    rows = texts.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(settings.buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source."""
    n, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    share = lambda s, t: (float(t) + 1) * (all_source + n) / ((float(s) + 1) * (all_target + n))
    return np.array([math.floor(1000 * math.log(share(s, t))) for s, t in zip(source, target)], np.int64)


def weighted(
    docs: DataFrame, gain: np.ndarray, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(_id, n_words, n_features, weight) of each row."""
    id_type = docs.schema[id_col].dataType
    names = ["n_words", "n_features", "weight"]
    schema = pa.schema([("_id", to_arrow_type(id_type)), *[(n, pa.int64()) for n in names]])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words, buckets = run_buckets(text.as_py() or b"", settings)
                rows.append((words, len(buckets), int(gain[buckets].sum())))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.record_batch([batch.column(0).cast(schema.field(0).type), *[pa.array(c, pa.int64()) for c in columns]], schema)

    fields = [T.StructField("_id", id_type), *[T.StructField(n, T.LongType()) for n in names]]
    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(scored, T.StructType(fields))


def gumbel(id_col: str, settings: Settings = Settings()) -> Column:
    """Thousandths of a Gumbel number, from a hash of the id; a missing id counts as empty text."""
    named = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def cutoff(rows: DataFrame, key: str, quota: int, cuts: int) -> tuple[int, int, int]:
    """The key of the ``quota``-th row in ascending order, the rows below it and those with it.

    Bisection with several thresholds a job: each job counts rows, and none is moved.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0  # rows with a key under ``low``
    while low < high:
        steps = sorted({low + (high - low) * i // (cuts + 1) for i in range(1, cuts + 1)})
        inside = rows.where(F.col(key).between(low, high))
        counts = inside.agg(*[F.count_if(F.col(key) <= s).alias(f"c{i}") for i, s in enumerate(steps)]).first()
        reached = [s for s, n in zip(steps, counts) if below + n >= quota]
        short = [(s, n) for s, n in zip(steps, counts) if below + n < quota]
        if reached:
            high = reached[0]
        if short:
            low, below = short[-1][0] + 1, below + short[-1][1]
    return low, below, rows.where(F.col(key) == low).count()


def drawn(rows: DataFrame, keys: list[str], quota: int, cuts: int) -> Column:
    """A condition that holds for the first ``quota`` rows in the order of the keys.

    Rows tied in one key are told apart by the next; the last key has no ties.
    """
    if quota <= 0:
        return F.lit(False)
    at, below, tied = cutoff(rows, keys[0], quota, cuts)
    if quota - below == tied:
        return F.col(keys[0]) <= at
    ties = drawn(rows.where(F.col(keys[0]) == at), keys[1:], quota - below, cuts)
    return (F.col(keys[0]) < at) | ((F.col(keys[0]) == at) & ties)


def resample(
    docs: DataFrame,
    target: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: the id column, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank`` among the drawn rows (1 for the highest score; NULL if not drawn).

    Texts that are missing or have no word weigh 0. Of equal scores the smaller id comes
    first; ids are whole numbers, a missing one comes last, and rows that share id and
    score are ordered by their place in the written scores. With an empty target or no
    documents the gains follow from counts of 0. Other columns are not read. No text is moved; the
    scores are written once, counted, and only drawn rows are ordered.
    """
    gain = gains(bucket_counts(docs, text_col, settings), bucket_counts(target, target_col, settings))
    scored = weighted(docs, gain, settings, id_col, text_col).withColumn("score", F.col("weight") + gumbel("_id", settings))
    place = F.coalesce(F.col("_id").cast("long"), F.lit(2**63 - 1))
    rows = written(
        scored.select("*", (-F.col("score")).alias("_best"), place.alias("_tie"), F.monotonically_increasing_id().alias("_place"))
    )
    keys = ["_best", "_tie", "_place"]
    enough = F.col("n_words") >= settings.min_words
    quota = settings.percent * rows.where(enough).count() // 100
    chosen = enough & drawn(rows.where(enough), keys, quota, settings.cuts)
    # Each range is ordered by itself; its rows are counted on from those of the ranges before it.
    ranges = rows.where(chosen).repartitionByRange(*keys)
    sliced = written(ranges.withColumn("_slice", F.spark_partition_id()))
    offsets = slice_offsets(sliced, [], F.count(F.lit(1))).select("_slice", "_before")
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*keys))
    ranked = sliced.withColumn("_inside", inside).join(offsets, "_slice").withColumn("rank", F.col("_before") + F.col("_inside"))
    columns = [F.col("_id").alias(id_col), "n_words", "n_features", "weight", "score", "rank"]
    others = rows.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(others.select(*columns))
