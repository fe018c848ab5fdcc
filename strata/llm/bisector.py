"""Clustering of vectors by integer k-means whose nearest centroid is found by a tournament of bisectors.

A vector becomes integers, floor(256 x) of each component. Of two centroids a < b, the nearer one is told
by the sign of a linear form: with the normal 2(b - a) and the threshold |b|^2 - |a|^2, the vector x is
nearer to b where normal . x > threshold; at zero the smaller number wins. Normals and thresholds of all
pairs are worked out once a round. A vector goes through k - 1 such tests, each between the winner so far
and the next centroid; every loser is out for good, as exact distances are ordered. Only the distance to
the last winner is worked out, in whole numbers.

Every round reads the vectors where they lie: tasks return the sums of their clusters alone, and what
comes to the driver is k centroids, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import stage

#: What a component is multiplied by before it is rounded down.
SCALE = 256

#: Largest integer component: beyond it the squared distance of 64 of them need not fit a long.
LARGEST = 1 << 27

#: Components up to this size are compared in floating point, which holds all sums of 64 products exactly.
EXACT = 1 << 22

#: Most cells of the table of normals, and vectors compared at once.
LARGEST_TABLE, BLOCK = 1 << 25, 8192


@dataclass
class Bisectors:
    """The integer centroids with ``normals[a, b]`` and ``thresholds[a, b]`` of the pairs a < b."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Bisectors:
        at = np.array(centroids, np.int64)
        if len(at) ** 2 * at.shape[1] > LARGEST_TABLE:
            raise ValueError(f"{len(at)} centroids make more than {LARGEST_TABLE} cells of normals")
        norms = (at * at).sum(1)
        return cls(at, 2 * (at[None, :, :] - at[:, None, :]), norms[None, :] - norms[:, None])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each integer vector and the squared distance to it."""
        parts = [self._nearest(vectors[at : at + BLOCK]) for at in range(0, len(vectors), BLOCK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if max(np.abs(x).max(initial=0), np.abs(self.centroids).max(initial=0)) <= EXACT:
            points, normals, thresholds = x.astype(np.float64), self.normals.astype(np.float64), self.thresholds.astype(np.float64)
        else:
            points, normals, thresholds = x, self.normals, self.thresholds
        winner = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", points, normals[winner, b]) - thresholds[winner, b]
            winner[side > 0] = b
        away = x - self.centroids[winner]
        return winner, (away * away).sum(1)


def integers(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have exactly ``size`` components, none null or not finite, and their integers."""
    n = len(column)
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    fit = lengths == size
    chosen = column.filter(pa.array(fit))
    flat = pc.cast(chosen.flatten(), pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, size)
    sound = np.isfinite(values).all(1)  # nulls arrive as NaN
    kept = np.zeros(n, bool)
    kept[np.flatnonzero(fit)[sound]] = True
    scaled = np.floor(SCALE * values[sound])
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST / SCALE:.0f}: squared distances would not fit a long")
    return kept, scaled.astype(np.int64)


def first_vectors(rows: DataFrame, vec_id: str, vector: str, k: int, size: int, seed: int) -> list[list[int]]:
    """The integers of the ``k`` vectors whose ids have the smallest hashes; ties go to the smaller vector."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = integers(batch.column(1), size)
            ids = batch.column(0).filter(pa.array(kept))
            yield pa.record_batch({"id": ids, "vector": pa.array(list(values), pa.list_(pa.int64()))})

    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id"), F.lit(""))).cast("binary"), 256)
    found = rows.select(F.col(vec_id).cast("string").alias("id"), vector).mapInArrow(keep, "id string, vector array<bigint>")
    return [r.vector for r in found.orderBy(drawn, "vector").limit(k).collect()]


def moved(rows: DataFrame, vector: str, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: rounded-down means of the vectors nearest to each; empty ones stay."""
    size = len(centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors.of(centroids)
        # The last component of a cluster counts its vectors.
        total = np.zeros((len(centroids), size + 1), object)
        for batch in batches:
            _, values = integers(batch.column(0), size)
            winner, _ = bisectors.nearest(values)
            part = np.zeros(total.shape, np.int64)
            np.add.at(part, winner, np.hstack([values, np.ones((len(values), 1), np.int64)]))
            total += part
        cluster, component = np.nonzero(total)
        numbers = pa.array([str(v) for v in total[cluster, component]], pa.string())
        yield pa.record_batch({"cluster": pa.array(cluster, pa.int32()), "component": pa.array(component, pa.int32()), "n": numbers})

    parts = rows.select(vector).mapInArrow(sums, "cluster int, component int, n string")
    summed = parts.groupBy("cluster", "component").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    total: dict[int, dict[int, int]] = {}
    for r in summed.collect():  # at most k * (size + 1) rows
        total.setdefault(r.cluster, {})[r.component] = int(r.n)
    return [
        [total[c].get(i, 0) // total[c][size] for i in range(size)] if c in total else old for c, old in enumerate(centroids)
    ]


def nearest(rows: DataFrame, vec_id: str, vector: str, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of the vectors that are kept."""
    size, kind = len(centroids[0]), rows.schema[vec_id].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors.of(centroids)
        for batch in batches:
            kept, values = integers(batch.column(1), size)
            winner, distance = bisectors.nearest(values)
            ids = batch.column(0).filter(pa.array(kept))
            yield pa.record_batch([ids, pa.array(winner, pa.int32()), pa.array(distance, pa.int64())], [vec_id, "cluster", "distance"])

    return rows.select(vec_id, vector).mapInArrow(assign, f"`{vec_id}` {kind}, cluster int, distance bigint")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 40, size: int = 64, rounds: int = 5, seed: int = 2
) -> DataFrame:
    """The cluster of each vector after ``rounds`` rounds, with the exact squared distance to its centroid.

    Returns ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``. Vectors that are null,
    have another number of components, or hold a null, NaN or infinite one are left out. Rows that repeat
    a vector or an id are all kept, each with its own row; a null id is hashed as the empty text.
    Of equal distances the smaller number wins. Fewer than ``k`` vectors make as many centroids; none,
    or an empty table, give no rows. Other columns take no part. A component beyond 2^19 raises an error,
    as squared distances are returned as longs.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    centroids = first_vectors(rows, vec_id, vector, k, size, seed)
    if not centroids:
        empty = f"`{vec_id}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return rows.sparkSession.createDataFrame([], empty)
    for _ in range(rounds):
        centroids = moved(rows, vector, centroids)
    found = stage(nearest(rows, vec_id, vector, centroids), "clusters")
    inertia = {r.cluster: int(r.n) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}

    def of_cluster(values: dict[int, object], kind: str) -> Column:
        return F.create_map(*[F.lit(x) for c, v in values.items() for x in (c, v)])[F.col("cluster")].cast(kind)

    return found.select(
        "*",
        of_cluster(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of_cluster({c: digest(centroids[c]) for c in inertia}, "string").alias("centroid_sha256"),
    )
