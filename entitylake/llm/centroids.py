"""Clusters around centroids, exact in integers; the nearest centroid is found by Orchard's search."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entitylake.llm.batches import column, share_code
from entitylake.session import materialized

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, "1"
ROWS = 8192  # vectors that are searched at once


class Orchard:
    """For each centroid the others, nearest first, and their squared distances."""

    def __init__(self, centroids: list[list[int]]):
        self.points = np.array(centroids, np.int64).reshape(len(centroids), len(centroids[0]) if centroids else 0)
        apart = ((self.points[:, None] - self.points[None]) ** 2).sum(axis=2)
        own = apart.copy()
        np.fill_diagonal(own, -1)  # a centroid comes first in its own list, also before an equal one
        self.lists = np.argsort(own, axis=1, kind="stable")
        self.gaps = np.take_along_axis(apart, self.lists, axis=1)

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each point's nearest centroid, the smaller number on a tie.

        A point walks down the list of its best centroid. A closer one found there is jumped to, and
        its list walked from the top; a centroid once measured is only passed. The walk ends at the
        first entry strictly further from the best centroid than twice the point is: by the triangle
        inequality neither it nor any later one is as near.
        """
        n, k = len(points), len(self.points)
        best, at = np.zeros(n, np.int64), np.ones(n, np.int64)
        near = ((points - self.points[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        walking = np.arange(n if k > 1 else 0)
        while len(walking):
            entry, gap = self.lists[best[walking], at[walking]], self.gaps[best[walking], at[walking]]
            reach = gap <= 4 * near[walking]
            walking, entry = walking[reach], entry[reach]
            at[walking] += 1
            fresh = ~seen[walking, entry]
            rows, found = walking[fresh], entry[fresh]
            seen[rows, found] = True
            distance = ((points[rows] - self.points[found]) ** 2).sum(axis=1)
            closer = (distance < near[rows]) | (distance == near[rows]) & (found < best[rows])
            rows, found = rows[closer], found[closer]
            near[rows], best[rows], at[rows] = distance[closer], found, 1
            walking = walking[at[walking] < k]
        return best, near


def _points(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    values = batch.column("point").flatten().to_numpy().astype(np.int64).reshape(-1, dim)
    for start in range(0, batch.num_rows, ROWS):
        yield start, values[start : start + ROWS]


def kept_points(rows: DataFrame, key: str, vector: str, dim: int, scale: int) -> DataFrame:
    """``(key, point)`` of the vectors with ``dim`` finite components, scaled and rounded down."""
    values = column(rows, vector).cast("array<double>")
    limit = isqrt((1 << 60) // dim) // 2  # four times the largest squared distance fits 64 bits
    chosen = rows.select(column(rows, key).alias("key"), values.alias("v")).where(F.size("v") == dim)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(limit))), F.lit(float(-limit))))
    return chosen.where(finite).select("key", F.transform("v", whole).cast("array<int>").alias("point"))


def first_centroids(points: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors whose keys have the ``k`` smallest hashes; vectors without a key come last."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    return [list(row.point) for row in points.orderBy(hashed.asc_nulls_last(), "point").limit(k).select("point").collect()]


def _sums(points: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """``(cluster, part, total, n)``: each task adds up its own vectors, then the tasks' sums are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Orchard(centroids)
        totals, sizes = np.zeros((len(centroids), dim), np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, own in _points(batch, dim):
                found, _ = index.search(own)
                np.add.at(totals, found, own)
                sizes += np.bincount(found, minlength=len(sizes))
        used = np.flatnonzero(sizes)
        columns = [np.repeat(used, dim), np.tile(np.arange(dim), len(used)), totals[used].ravel(), np.repeat(sizes[used], dim)]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["cluster", "part", "total", "n"])

    sums = points.mapInArrow(run, "cluster long, part long, total long, n long")
    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("total", "n")]
    return sums.groupBy("cluster", "part").agg(*exact)


def _assigned(points: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Orchard(centroids)
        for batch in batches:
            for start, own in _points(batch, dim):
                found, near = index.search(own)
                columns = [batch.column("key").slice(start, len(own)), pa.array(found.astype(np.int32)), pa.array(near)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    kind = points.schema["key"].dataType.simpleString()
    return points.mapInArrow(run, f"key {kind}, cluster int, distance long")


def clustered(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
    dim: int = DIM, scale: int = SCALE, seed: str = SEED, watch: Callable[[list[list[int]]], None] | None = None,
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept vector.

    Vectors with exactly ``dim`` components, none null or not finite, are kept, zero ones too; their
    components times ``scale`` are rounded down to integers. (Beyond ``isqrt(2**60 // dim) // 2``,
    67 million for 64 components, they are set to that bound, so that squares fit.) Repeated rows
    count as often as they come. The ``k`` starting centroids have the smallest SHA-256 of
    ``seed:key``; with fewer vectors there are fewer. Each round moves every centroid to the rounded
    down mean of its vectors; one without vectors stays. Distances are squared. No vectors, no rows.

    The centroids, ``k * dim`` numbers, go to all tasks and come back as sums; vectors never move.
    ``watch`` is called with the centroids of every round, the last ones included.
    """
    share_code(rows.sparkSession)
    points = materialized(kept_points(rows, key, vector, dim, scale), "points")
    centroids = first_centroids(points, k, seed)
    for _ in range(rounds):
        if watch:
            watch(centroids)
        moved = [list(point) for point in centroids]
        for row in _sums(points, centroids, dim).collect():  # k * dim rows at most
            moved[row.cluster][row.part] = int(row.total) // int(row.n)
        centroids = moved
    if watch:
        watch(centroids)
    found = materialized(_assigned(points, centroids, dim), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertias = {row.cluster: int(row.inertia) for row in found.groupBy("cluster").agg(exact.alias("inertia")).collect()}
    top = (1 << 63) - 1
    facts = [
        (i, min(inertias.get(i, 0), top), min(sum(inertias.values()), top), sha256(",".join(map(str, point)).encode()).hexdigest())
        for i, point in enumerate(centroids)
    ]
    named = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(named), "cluster")  # k rows
    return joined.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
