"""Centroid clustering of vectors of whole numbers.

The nearest centroid is found by the threshold algorithm: each dimension keeps the
centroids in the order of its value, and from a vector's own value all these lists are
walked outward in step. A centroid met for the first time gets its exact distance. What
no list has met is at least as far as all frontiers together, so a vector is done once
the sum of its frontier distances strictly exceeds its best exact distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siglake.session import written

# Vectors whose distances to all centroids are held at a time.
BLOCK = 1024


@dataclass(frozen=True)
class Settings:
    """clusters: number of centroids. size: components of a vector; others are left out.
    scale: a component x becomes the whole number floor(scale * x). rounds: how often
    centroids are moved. seed: part of the hash that chooses the first centroids."""

    clusters: int = 16
    size: int = 64
    scale: int = 64
    rounds: int = 3
    seed: int = 1


def whole(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, _v): the vectors of the right size without a missing or infinite component, as whole numbers."""
    x = F.col(vector_col)
    number = lambda v: v.cast("double")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(number(v)) & (F.abs(number(v)) < float("inf")))
    kept = vectors.where(x.isNotNull() & (F.size(x) == settings.size) & finite)
    return kept.select(F.col(id_col).alias("_id"), F.transform(x, lambda v: F.floor(number(v) * settings.scale)).alias("_v"))


def first_centroids(numbers: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; equal ids by components.

    There are fewer if the table has fewer. A row without an id comes after all others.
    """
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("_id").cast("string")), 256)
    rows = numbers.orderBy(digest.asc_nulls_last(), "_v").limit(settings.clusters).collect()
    return np.array([r["_v"] for r in rows], np.int64).reshape(len(rows), settings.size)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; of equal ones the first."""
    clusters, distances = np.empty(len(vectors), np.int32), np.empty(len(vectors), np.int64)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    for start in range(0, len(vectors), BLOCK):
        block = slice(start, start + BLOCK)
        clusters[block], distances[block] = _walk(vectors[block], centroids, order, lists)
    return clusters, distances


def _walk(vectors, centroids, order, lists):
    k, far = len(centroids), np.iinfo(np.int64).max
    dims = np.arange(vectors.shape[1])
    below = np.stack([np.searchsorted(lists[:, d], vectors[:, d]) - 1 for d in dims], axis=1)
    above = below + 1
    known = np.full((len(vectors), k), far)
    live = np.arange(len(vectors))
    while len(live):
        v, low, high = vectors[live], below[live], above[live]
        down = np.where(low >= 0, v - lists[np.maximum(low, 0), dims], far)
        up = np.where(high < k, lists[np.minimum(high, k - 1), dims] - v, far)
        lower = down <= up
        met = np.zeros((len(live), k), bool)
        met[np.arange(len(live))[:, None], order[np.where(lower, np.maximum(low, 0), np.minimum(high, k - 1)), dims]] = True
        rows, new = np.nonzero(met & (known[live] == far))
        known[live[rows], new] = ((v[rows] - centroids[new]) ** 2).sum(axis=1)
        frontier = (np.minimum(down, up) ** 2).sum(axis=1)
        below[live], above[live] = low - lower, high + ~lower
        best = known[live].min(axis=1)
        live = live[(frontier <= best) & (known[live] == far).any(axis=1)]
    return known.argmin(axis=1), known.min(axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    found = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    most = math.isqrt((2**63 - 1) // size) // 2
    if found.size and max(int(found.max()), -int(found.min())) > most:
        raise ValueError(f"a component exceeds {most} after scaling, so that distances exceed 64 bits")
    return found


def assign(numbers: DataFrame, centroids: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """(_id, cluster, distance) of each vector. Rows stay in their task."""
    id_type = numbers.schema["_id"].dataType
    schema = pa.schema([("_id", to_arrow_type(id_type)), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = nearest(_matrix(batch.column(1), settings.size), centroids)
                ids = batch.column(0).cast(schema.field(0).type)
                yield pa.record_batch([ids, *map(pa.array, found)], schema)

    fields = [T.StructField("_id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    return numbers.select("_id", "_v").mapInArrow(assigned, T.StructType(fields))


def moved(numbers: DataFrame, centroids: np.ndarray, settings: Settings = Settings()) -> np.ndarray:
    """The centroids after each took the floor of its vectors' mean; those without a vector stay.

    Each task adds up its vectors, so what moves is one row per task and centroid, and
    what reaches the driver is one number per centroid and component.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), settings.size)
                clusters, _ = nearest(vectors, centroids)
                np.add.at(sums, clusters, vectors)
                counts += np.bincount(clusters, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    parts = numbers.select("_v").mapInArrow(added, "cluster int, n long, sums array<long>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("d", "total")).groupBy("cluster", "d").agg(exact("n"), exact("total"))
    out = centroids.copy()
    for row in totals.collect():
        out[row["cluster"], row["d"]] = int(row["total"]) // int(row["n"])
    return out


def by_cluster(values: dict[int, object], kind: str) -> Column:
    """The value of each row's cluster, from one per centroid."""
    if not values:
        return F.lit(None).cast(kind)
    pairs = [F.lit(x) for number, value in sorted(values.items()) for x in (number, value)]
    return F.element_at(F.create_map(*pairs), F.col("cluster")).cast(kind)


def cluster(
    vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per vector of the right size: the id column, ``cluster``, ``distance`` (squared),
    ``cluster_inertia``, ``inertia`` (distances summed over the cluster and over all) and
    ``centroid`` (the cluster's final centroid, an array).

    Vectors of another size, or with a missing, NaN or infinite component, are left out.
    Rows that share an id, or have none, are vectors of their own. With fewer vectors
    than centroids there are as many centroids as vectors; without vectors there is no row.
    Other columns are not read. A component beyond 2**27 after scaling (64 dimensions)
    is an error, as distances would not fit a long. Each round is one pass over the table.
    """
    numbers = whole(vectors, settings, id_col, vector_col)
    centroids = first_centroids(numbers, settings)
    for _ in range(settings.rounds if len(centroids) else 0):
        centroids = moved(numbers, centroids, settings)
    found = written(assign(numbers, centroids, settings) if len(centroids) else numbers.select("_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"))
    sums = {
        r["cluster"]: int(r["s"])
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    }
    return found.select(
        F.col("_id").alias(id_col),
        "cluster",
        "distance",
        by_cluster(sums, "long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        by_cluster({i: F.array(*map(F.lit, c.tolist())) for i, c in enumerate(centroids)}, "array<long>").alias("centroid"),
    )

