"""Clustering around centroids in whole numbers, each vector's nearest centroid found by annulus search.

Centroids are sorted by norm.  A vector's distance to the centroid of the nearest norm is an upper bound u, and a centroid
whose norm differs from the vector's by more than u is farther away (triangle inequality), so a binary search finds the
run of centroids within the annulus [norm - u, norm + u], and only these are compared, exactly, in 64-bit integers.  The bounds are
widened by more than the norms' rounding, so ties on the annulus's edge are compared too; of equals the smaller number wins.

Every round is one pass: tasks sum their vectors by centroid, so a round shuffles at most a row per task and centroid, and the
driver gets k centroids.  Vectors are kept if they have `dims` components, none null or non-finite; repeated rows count each;
a null vec_id is hashed as the empty text.  Other columns are left aside.  No vectors, no rows; fewer than k, fewer centroids.
A component beyond 2^27 after scaling raises ValueError: squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch_limits, broadcast, small_batches, stage

LARGEST = 1 << 27


class Centroids:
    """Centroids sorted by norm; `number` holds their places in the given order."""

    def __init__(self, rows: np.ndarray):
        norms = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
        self.number = np.argsort(norms, kind="stable")
        self.rows, self.norms = rows[self.number], norms[self.number]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of and squared distance to the nearest centroid of each row, and how many distances were computed."""
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        right = np.clip(np.searchsorted(self.norms, norm), 0, len(self.norms) - 1)
        left = np.maximum(right - 1, 0)
        pivot = np.where(norm - self.norms[left] <= self.norms[right] - norm, left, right)
        best = ((x - self.rows[pivot]) ** 2).sum(1)
        number, bound = self.number[pivot], np.sqrt(best.astype(np.float64))
        slack = 1e-6 + 1e-9 * (norm + bound)
        low, high = np.searchsorted(self.norms, norm - bound - slack, "left"), np.searchsorted(self.norms, norm + bound + slack, "right")
        tried = len(x)
        for j, (row, n) in enumerate(zip(self.rows, self.number, strict=True)):
            here = np.flatnonzero((low <= j) & (j < high) & (pivot != j))
            tried += len(here)
            away = ((x[here] - row) ** 2).sum(1)
            nearer = (away < best[here]) | (away == best[here]) & (n < number[here])
            best[here[nearer]], number[here[nearer]] = away[nearer], n
        return number, best, tried


def whole_vectors(embeddings: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, v: floor(scale * component) of the vectors kept."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    kept = embeddings.select("vec_id", x.alias("x")).filter(F.coalesce((F.size("x") == dims) & F.forall("x", sound), F.lit(False)))
    large = F.exists("x", lambda c: F.abs(c) * scale >= LARGEST)
    v = F.when(large, F.raise_error(F.lit("a component is too large for whole distances"))).otherwise(F.transform("x", lambda c: F.floor(c * scale).cast("long")))
    return kept.select("vec_id", v.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(vectors: DataFrame, rows: np.ndarray, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of the vectors nearest to each centroid."""
    sent = broadcast(vectors.sparkSession, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(sent.value)
        sums, counts = np.zeros((len(sent.value), dims), np.int64), np.zeros(len(sent.value), np.int64)
        for b in batches:
            x = _matrix(b.column("v"), dims)
            number = centroids.nearest(x)[0]
            if len(x):
                order = np.argsort(number, kind="stable")
                present, first = np.unique(number[order], return_index=True)
                sums[present] += np.add.reduceat(x[order], first)
                counts += np.bincount(number, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(at, pa.int32()), "n": pa.array(counts[at]), "s": pa.array(sums[at].tolist(), pa.list_(pa.int64()))})

    part = vectors.select("v").mapInArrow(run, "cluster int, n long, s array<long>")
    total = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(dims)])
    return {r["cluster"]: (r["n"], [r[f"s{i}"] for i in range(dims)]) for r in total.collect()}  # k rows


def cluster(embeddings: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 (of the final centroid's components).

    The first centroids are the k vectors of the smallest sha256 of `seed:vec_id`, ties by components.  A round replaces each
    centroid that has vectors by the floor of their mean.
    """
    spark = embeddings.sparkSession
    vectors = stage(whole_vectors(embeddings, dims, scale), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = np.array([r["v"] for r in vectors.orderBy(key, "v").limit(k).collect()], np.int64).reshape(-1, dims)  # k rows
    with batch_limits(spark):
        for _ in range(rounds if len(rows) else 0):
            for c, (n, s) in _sums(vectors, rows, dims).items():
                rows[c] = [x // n for x in s]
    sent = broadcast(spark, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(sent.value) if len(sent.value) else None
        for b in batches:
            if len(b):
                number, distance, _ = centroids.nearest(_matrix(b.column("v"), dims))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    small_batches(spark)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    placed = stage(vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), "clusters")
    own = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in rows.tolist()]
    facts = spark.createDataFrame([(c, own[c], sum(own.values()), digests[c]) for c in own], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # facts: k rows
