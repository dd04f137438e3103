"""Clusters around centroids of whole components: exact, so that the result depends on no order and no partitioning.

A vector's components become floor(scale * x). The k vectors of least sha256 of `salt:id` are the first centroids. A round takes two
steps: tasks find the nearest centroid of each vector from |x|^2 - 2 x.c + |c|^2, a matrix product of a block of vectors and all
centroids in float64 BLAS, which is exact as long as a bound of its magnitudes stays below 2^53 (whole numbers otherwise), and add up
the vectors of each centroid; treeAggregate combines the k sums of every task. The centroids, k vectors, are all that ever is at the
driver or goes to the tasks; nothing but the input is read, so that a lost task is computed again from it.

Defined results: vectors that are null, of another dimension or hold null or non-finite components take no part; rows that are
repeated count as often as they occur; rows with a null id are clustered, but start no cluster while others can; of rows with one id
the least vector starts first; with fewer than k vectors there are fewer centroids; ties go to the centroid of smaller number; an empty
cluster keeps its centroid; distances and sums beyond a long are null; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, batch, mapped
from .integer_blocks import EXACT, LONG, added, distances, floors, matrix, size, sound, whole


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row, the smallest of equally near ones, and the squared distance."""
    d = distances(x, centroids)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def sums(x: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The sums of the rows of each cluster: one more product, of marks and rows, where it is exact."""
    if len(x) * size(x) < EXACT:
        return ((np.arange(k)[:, None] == at).astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
    out = np.zeros((k, x.shape[1]), object)
    np.add.at(out, at, whole(x, object))
    return out


class Totals:
    """What some rows add to their clusters: sums of their vectors, their number, sums of their distances."""

    def __init__(self, total=None, count=None, distance=None):
        self.total, self.count, self.distance = total, count, distance

    def __add__(self, other: Totals) -> Totals:
        if other.total is None:
            return self
        return Totals(added(self.total, other.total), added(self.count, other.count), added(self.distance, other.distance))


def _column(values: np.ndarray) -> pa.Array:
    return pa.array([int(v) if -LONG <= v < LONG else None for v in values.tolist()], pa.int64())


def _pass(vectors: DataFrame, centroids: np.ndarray, scale: int) -> Totals:
    """The totals of all clusters: one row of each task, added up by a tree of tasks."""
    held, k = vectors.sparkSession.sparkContext.broadcast(centroids), len(centroids)

    def local(batches: Batches) -> Iterator[pa.RecordBatch]:
        out = Totals()
        for b in batches:
            if b.num_rows:
                x = floors(matrix(b.column("vector")), scale)
                at, d = nearest(x, held.value)
                far = np.zeros(k, object)
                np.add.at(far, at, whole(d, object))
                out += Totals(sums(x, at, k), np.bincount(at, minlength=k), far)
        if out.total is not None:
            yield batch(totals=pa.array([json.dumps([[[int(v) for v in r] for r in out.total.tolist()], out.count.tolist(), [int(v) for v in out.distance.tolist()]])]))

    def read(row) -> Totals:
        return Totals(*(np.array(part, object) for part in json.loads(row.totals)))

    return vectors.select("vector").transform(mapped, local, "totals string").rdd.map(read).treeAggregate(Totals(), lambda a, b: a + b, lambda a, b: a + b)


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dimension: int = 64, salt: str = "1", id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    rows = rows.where(sound(v) & (F.size(v) == dimension))
    first = rows.orderBy(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "vector").limit(k).collect()
    centroids = floors(np.array([r.vector for r in first], np.float64).reshape(len(first), dimension), scale)
    inertia = np.zeros(len(first), object)
    if first:
        for _ in range(rounds):
            t = _pass(rows, centroids, scale)
            new = [[s // n for s in total] if n else [int(c) for c in c_old] for total, n, c_old in zip(t.total.tolist(), t.count.tolist(), centroids.tolist(), strict=True)]
            centroids = np.array(new, object)
            centroids = centroids.astype(np.float64) if size(centroids) < EXACT else centroids
        inertia = _pass(rows, centroids, scale).distance
    each = _column(inertia)
    total = _column(np.array([sum(inertia.tolist())], object))[0]
    named = pa.array([hashlib.sha256(",".join(str(int(c)) for c in r).encode()).hexdigest() for r in centroids.tolist()], pa.string())
    held = rows.sparkSession.sparkContext.broadcast(centroids)

    def assigned(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at, d = nearest(floors(matrix(b.column("vector")), scale), held.value)
                took = pa.array(at, pa.int32())
                yield batch(vec_id=b.column("vec_id"), cluster=took, distance=_column(d), cluster_inertia=each.take(took), inertia=pa.repeat(total, len(at)), centroid_sha256=named.take(took))

    return rows.transform(mapped, assigned, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
