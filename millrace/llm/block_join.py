"""Nearest neighbours by a block matrix join: int8 product tiles with error bounds, exact scores for what survives, heaps to merge.

Candidates are dealt to stripes of bounded size, and every query visits every stripe: a stated query set against all rows, in blocks.
Stripes are as large as a task can hold, since each takes all queries once more. A tile is the product of the int8 codes of a block of
queries and of a block of the stripe. With x = sx*a + dx and y = sy*b + dy,
|x.y - sx*sy*(a.b)| <= |x||dy| + |dx|(|y| + |dy|), so a candidate whose upper bound lies below the k-th greatest lower bound of its
query, or below the k-th score that the stripe has given so far, cannot be among the k nearest. The others are computed again in double precision. Each pair of query and stripe gives one
sorted list; the lists of a query are merged with a heap. The result is exact, so recall is 1.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors are only compared
with others of their dimension; rows equal in id and vector count once; rows with one id and different vectors are candidates of
each other; ties go to the smaller id; fewer than k candidates give
fewer rows; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, batch, longs, mapped, parts_for

#: Bytes of the vectors of one stripe, at most about so many as doubles; candidates of a stripe, at least about so many where there
#: are more tasks than large stripes.
STRIPE_BYTES, LEAST = 32 << 20, 4096
#: Candidates and queries of one tile.
TILE, BLOCK = 8192, 256
#: Pairs whose exact scores are computed at once.
MOST = 1 << 16


class Coded:
    """Vectors of one dimension, their int8 codes and the bounds of their errors."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, x: np.ndarray):
        self.ids, self.keys, self.x = ids, keys, x
        self.scale = np.abs(x).max(axis=1) / 127
        self.codes = np.rint(x / self.scale[:, None]).astype(np.int8)
        self.error = np.sqrt(((x - self.codes * self.scale[:, None]) ** 2).sum(axis=1))
        self.norm = np.sqrt((x * x).sum(axis=1))


def tile(q: Coded, c: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Approximate products and the bounds of their errors. Sums of int8 products are exact in float32 below 2**24, else in float64."""
    kind = np.float32 if q.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q.codes.astype(kind) @ c.codes.astype(kind).T).astype(np.float64) * q.scale[:, None] * c.scale
    bound = q.norm[:, None] * c.error + q.error[:, None] * (c.norm + c.error)
    return product, bound * (1 + 1e-9) + 1e-12 * q.norm[:, None] * c.norm


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    return total


def nearest(q: Coded, stripe: list[Coded], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query ids and scores of its k nearest of the stripe, best first."""
    n = len(q.ids)
    query, score, ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    floor = np.full(n, -np.inf)  # the k-th score so far
    for c in stripe:
        product, bound = tile(q, c)
        own = (q.keys[:, None] == c.keys) & (q.ids[:, None] == c.ids)
        low = np.where(own, -np.inf, product - bound)
        least = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k]) if low.shape[1] >= k else floor
        i, j = np.nonzero((product + bound >= least[:, None]) & ~own)
        fresh = [exact(q.x[i[a : a + MOST]], c.x[j[a : a + MOST]]) for a in range(0, len(i), MOST)]
        query, score, ids = np.r_[query, i], np.concatenate([score, *fresh]), np.r_[ids, c.ids[j]]
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        turn = np.arange(len(query)) - np.searchsorted(query, query)
        floor[query[turn == k - 1]] = score[turn == k - 1]
        query, score, ids = query[turn < k], score[turn < k], ids[turn < k]
    at = np.searchsorted(query, np.arange(n + 1))
    for a, z in zip(at[:-1], at[1:], strict=True):
        yield ids[a:z], score[a:z]


def _matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each dimension of a list column without nulls."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[at[rows][:, None] + np.arange(d)]


def _coded(held: list[pa.Table]) -> dict[int, list[Coded]]:
    """The different candidates of a stripe, by dimension, in blocks."""
    if not held:
        return {}
    whole = pa.concat_tables(held).combine_chunks()
    ids, keys = longs(whole.column("id").combine_chunks()), longs(whole.column("key").combine_chunks())
    order = np.lexsort((ids, keys))
    first = order[np.r_[True, (keys[order][1:] != keys[order][:-1]) | (ids[order][1:] != ids[order][:-1])]]
    out: dict[int, list[Coded]] = {}
    for a in range(0, len(first), TILE):
        part = first[a : a + TILE]
        for r, x in _matrices(whole.column("vector").take(pa.array(part)).combine_chunks()):
            out.setdefault(x.shape[1], []).append(Coded(ids[part[r]], keys[part[r]], x))
    return out


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every row for which the condition `queries` holds."""
    spark = vectors.sparkSession
    v = F.col("vector")
    sound = F.size(v) > 0
    for bad in (lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),):
        sound &= ~F.exists(v, bad)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & sound & F.exists(v, lambda x: x != 0)).withColumn("key", F.xxhash64("id", "vector"))
    count, values = rows.agg(F.count("id"), F.sum(F.size("vector"))).first()
    stripes = max(1, -(-(values or 0) * 8 // STRIPE_BYTES), min(parts_for(spark), count // LEAST))
    own = rows.select(F.pmod(F.xxhash64("key"), F.lit(stripes)).cast("int").alias("stripe"), F.lit(0).alias("kind"), "key", "id", "vector")
    asked = rows.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(1).alias("kind"), "key", "id", "vector")

    def tiles(batches: Batches) -> Iterator[pa.RecordBatch]:
        stripe, held, coded = None, [], None
        for b in batches:
            t = pa.Table.from_batches([b])
            marks = b.column("stripe").to_numpy().astype(np.int64) * 2 + b.column("kind").to_numpy()
            edges = np.r_[0, np.flatnonzero(np.diff(marks)) + 1, len(marks)]
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a == z:
                    continue
                part, now = t.slice(a, z - a), int(marks[a])
                if now // 2 != stripe:
                    stripe, held, coded = now // 2, [], None
                if now % 2 == 0:
                    held.append(part)
                    continue
                if coded is None:
                    coded = _coded(held)
                    held = []
                ids, keys = longs(part.column("id").combine_chunks()), longs(part.column("key").combine_chunks())
                for r, x in _matrices(part.column("vector").combine_chunks()):
                    if (c := coded.get(x.shape[1])) is not None:
                        lists = list(nearest(Coded(ids[r], keys[r], x), c, k))
                        yield batch(key=keys[r], query_id=ids[r], stripe=pa.array(np.full(len(r), stripe), pa.int32()), ids=pa.array([y[0] for y in lists], pa.list_(pa.int64())), scores=pa.array([y[1] for y in lists], pa.list_(pa.float64())))

    found = own.unionByName(asked).repartition(stripes, "stripe").sortWithinPartitions("stripe", "kind", "key").transform(mapped, tiles, "key long, query_id long, stripe int, ids array<long>, scores array<double>", rows=BLOCK)

    def merge(batches: Batches) -> Iterator[pa.RecordBatch]:
        held, last = {}, None
        for b in batches:
            for key, q, stripe, ids, scores in zip(*(b.column(n).to_pylist() for n in ("key", "query_id", "stripe", "ids", "scores")), strict=True):
                if last is not None and last != (key, q):
                    yield _merged(last[1], held, k)
                    held = {}
                last = (key, q)
                held[stripe] = [(-s, i) for i, s in zip(ids, scores, strict=True)]
        if last is not None:
            yield _merged(last[1], held, k)

    return found.repartition("key").sortWithinPartitions("key", "query_id").transform(mapped, merge, "query_id long, rank int, vec_id long, score double")


def _merged(query: int, lists: dict, k: int) -> pa.RecordBatch:
    best = list(islice(heapq.merge(*lists.values()), k))
    return batch(query_id=pa.array([query] * len(best), pa.int64()), rank=pa.array(range(1, len(best) + 1), pa.int32()), vec_id=pa.array([i for _, i in best], pa.int64()), score=pa.array([-s for s, _ in best], pa.float64()))
