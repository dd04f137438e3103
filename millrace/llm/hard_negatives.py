"""Hard negatives by a block matrix product in two dimensions: rows and components are both cut, partial tiles are added by a shuffle.

1. Anchors and rows are dealt to blocks. A block holds rows of one kind (dimension and label) or, of kinds with few rows, of a pool of
   kinds; a kind with many rows, hot or not, has as many blocks as it needs.
2. Each block is packed once for every chunk of components. An anchor block goes to every row block that it must meet, and a row block
   to every anchor block; a task multiplies the two chunks that met, exactly, to a partial tile of int64 scores.
3. Partial tiles of one pair of blocks are added by a shuffle, and the tile gives the best few of each anchor; tasks keep the best of
   all their tiles of an anchor, so that few go to the last ranking.

This runs twice: over blocks that may share a kind, for the positives of each anchor, and over all other pairs, where each anchor and
positive has a window of scores for its negatives. A pair of blocks of one kind is only met by the first, one of two kinds by the second.
A stated set of anchors meets all rows, in blocks; that is the search asked for. Blocks, not rows, are replicated.

Defined results: rows with a null id, label or vector, without components, or with null or non-finite components take no part; vectors
are only compared with others of their dimension; rows equal in id, label and vector count once; rows with one id that differ otherwise
are different rows; ties go to the smaller id; pairs whose score is beyond a long are left out; fewer positives or negatives give fewer
rows; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, batch, longs, mapped, stored
from .integer_blocks import LONG, added, decoded, encoded, floors, matrix, products, sound

#: Rows and anchors of one block, at most about so many; bytes of a block as doubles; components of a chunk; kinds with blocks of their own.
ROWS, ANCHORS, BLOCK_BYTES, CHUNK, KINDS = 4096, 256, 16 << 20, 32, 1024


def _cells(rows: DataFrame, block_rows: int | None) -> tuple[DataFrame, DataFrame, int, int, int, int]:
    """Which cell each kind with many rows has, the blocks of each cell, and the numbers of pools, first pool, anchor and row blocks.

    Both tables have at most about 2 * KINDS rows, whatever the input: a kind of its own has at least 1/KINDS of all rows, and so has a pool.
    """
    spark = rows.sparkSession
    kinds = stored(rows.groupBy("d", "label").agg(F.count("id").alias("n"), F.count_if("asks").alias("a")))
    total, widest = kinds.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("d"), F.lit(1))).first()
    most = block_rows or max(64, min(ROWS, BLOCK_BYTES // (8 * widest)))
    least = max(most // 2, total // KINDS)
    own = kinds.where(F.col("n") > least).orderBy("d", "label").collect()
    pools = max(1, -(-(total - sum(r.n for r in own)) // max(most, total // KINDS)))
    shared = {r.pool: r for r in kinds.where(F.col("n") <= least).groupBy(F.pmod(F.xxhash64("d", "label"), F.lit(pools)).cast("int").alias("pool")).agg(F.sum("n").alias("n"), F.sum("a").alias("a")).collect()}
    cells, i, j = [], 0, 0
    for c, r in enumerate([*own, *(shared.get(p) for p in range(pools))]):
        a, n = (-(-r.a // min(ANCHORS, most)), -(-r.n // most)) if r else (0, 0)
        cells.append((c, c < len(own), i, a, j, n))
        i, j = i + a, j + n
    named = spark.createDataFrame([(r.d, r.label, c) for c, r in enumerate(own)], "d int, label long, cell int")
    return named, spark.createDataFrame(cells, "cell int, pure boolean, a_from int, a_blocks int, r_from int, r_blocks int"), pools, len(own), i, j


def _packed(rows: DataFrame, block_rows: int | None, scale: int, chunk: int) -> tuple[DataFrame, int, int]:
    """side (0 anchors, 1 rows), block, k, matrix, meta, and the range of the other side's blocks of its cell (low, high, pure)."""
    named, cells, pools, first_pool, anchors, others = _cells(rows, block_rows)
    dealt = rows.join(F.broadcast(named), ["d", "label"], "left")
    dealt = dealt.withColumn("cell", F.coalesce("cell", F.lit(first_pool) + F.pmod(F.xxhash64("d", "label"), F.lit(pools)).cast("int"))).join(F.broadcast(cells), "cell")

    def place(side: int, begin: str, n: str, other: str, m: str) -> Column:
        at = (F.col(begin) + F.pmod(F.xxhash64("key", F.lit(side)), F.greatest(F.col(n), F.lit(1)))).cast("int")
        return F.struct(F.lit(side).alias("side"), at.alias("block"), F.col(other).alias("low"), (F.col(other) + F.col(m) - 1).alias("high"), "pure")

    a, r = place(0, "a_from", "a_blocks", "r_from", "r_blocks"), place(1, "r_from", "r_blocks", "a_from", "a_blocks")
    sides = dealt.select("id", "label", "key", "vector", F.explode(F.when(F.col("asks"), F.array(a, r)).otherwise(F.array(r))).alias("s")).select("s.*", "id", "label", "key", "vector")

    def pack(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            marks = b.column("block").to_numpy().astype(np.int64) * 2 + b.column("side").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for x, z in zip(edges[:-1], edges[1:], strict=True):
                if x == z:
                    continue
                part = b.slice(x, z - x)
                if held and any(held[0].column(c)[0].as_py() != part.column(c)[0].as_py() for c in ("side", "block")):
                    yield from blocks(held)
                    held = []
                held.append(part)
        if held:
            yield from blocks(held)

    def blocks(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        side, block, low, high, pure = (t.column(c)[0].as_py() for c in ("side", "block", "low", "high", "pure"))
        vectors = t.column("vector").combine_chunks()
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        if (sizes == sizes[0]).all():
            x = matrix(vectors)
        else:  # of a pool: shorter vectors are filled with zeros, and only meet those of their own dimension
            x = np.zeros((len(sizes), sizes.max()))
            x[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = vectors.flatten().to_numpy(zero_copy_only=False)
        x = floors(x, scale)
        meta = encoded(np.stack([*(longs(t.column(c).combine_chunks()) for c in ("id", "label", "key")), sizes]))
        for k, at in enumerate(range(0, x.shape[1], chunk)):
            yield batch(side=pa.array([side], pa.int32()), block=pa.array([block], pa.int32()), k=pa.array([k], pa.int32()), low=pa.array([low], pa.int32()), high=pa.array([high], pa.int32()), pure=pa.array([pure]), matrix=pa.array([encoded(x[:, at : at + chunk])], pa.binary()), meta=pa.array([None if k else meta], pa.binary()))

    out = sides.repartition("side", "block").sortWithinPartitions("side", "block", "id", "key").transform(mapped, pack, "side int, block int, k int, low int, high int, pure boolean, matrix binary, meta binary")
    return stored(out), anchors, others


def _tiles(packed: DataFrame, anchors: int, others: int, same_kind: bool) -> DataFrame:
    """i, j, k, tile, a_meta, r_meta of the partial tiles of all pairs of blocks that may share a kind, or that needn't."""
    count = F.when(F.col("side") == 0, F.lit(others)).otherwise(F.lit(anchors))
    inside = F.when(F.col("high") >= F.col("low"), F.sequence("low", "high")).otherwise(F.array().cast("array<int>"))
    every = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    partners = inside if same_kind else F.filter(every, lambda x: ~(F.col("pure") & x.between(F.col("low"), F.col("high"))))
    met = packed.select("side", "block", "k", "matrix", "meta", F.explode(partners).alias("other"))
    met = met.select(F.when(F.col("side") == 0, F.col("block")).otherwise(F.col("other")).alias("i"), F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("block")).alias("j"), "k", "side", "matrix", "meta")

    def multiply(batches: Batches) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            for n, at in enumerate(zip(*(b.column(c).to_pylist() for c in ("i", "j", "k", "side")), strict=True)):
                if at[3] == 0:
                    last = (at[:3], decoded(b.column("matrix")[n].as_buffer()), b.column("meta")[n].as_py())
                elif last and last[0] == at[:3]:
                    left, right = last[1], decoded(b.column("matrix")[n].as_buffer())
                    wide = min(left.shape[1], right.shape[1])  # what only one block has belongs to another dimension
                    tile = products(left[:, :wide], right[:, :wide])
                    yield batch(**{c: pa.array([v], pa.int32()) for c, v in zip("ijk", at, strict=False)}, tile=pa.array([encoded(tile)], pa.binary()), a_meta=pa.array([last[2]], pa.binary()), r_meta=b.column("meta").slice(n, 1))

    return met.repartition("i", "j", "k").sortWithinPartitions("i", "j", "k", "side").transform(mapped, multiply, "i int, j int, k int, tile binary, a_meta binary, r_meta binary")


class Best:
    """The best few of some lists, each with a key of its own: (score, id, key) by descending score and ascending id."""

    def __init__(self, most: int):
        self.most, self.held = most, {}

    def add(self, name: tuple, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        if len(score) > self.most:
            ok = score >= np.partition(score, -self.most)[-self.most]
            score, ids, keys = score[ok], ids[ok], keys[ok]
        if name in self.held:
            score, ids, keys = (np.concatenate(x) for x in zip(self.held[name], (score, ids, keys), strict=True))
        order = np.lexsort((keys, ids, -score))[: self.most]
        self.held[name] = (score[order], ids[order], keys[order])


def _summed(tiles: Batches) -> Iterator[tuple]:
    """(i, j, asked, scores, whether they fit a long, anchors' meta, rows' meta) of each tile, from its sorted partial tiles."""
    at, total, metas, asked = None, None, None, None
    for b in tiles:
        for n, (i, j, k) in enumerate(zip(*(b.column(c).to_pylist() for c in "ijk"), strict=True)):
            if at != (i, j):
                if metas:
                    yield *at, asked, *_fitting(total), *metas
                at, total, metas, asked = (i, j), None, None, None
            if k < 0:
                asked = b.column("asked")[n].as_py()
                continue
            total = added(total, decoded(b.column("tile")[n].as_buffer()))
            if k == 0:
                metas = [decoded(b.column(c)[n].as_buffer()) for c in ("a_meta", "r_meta")]
    if metas:
        yield *at, asked, *_fitting(total), *metas


def _fitting(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if total.dtype != object:
        return total.astype(np.int64), np.ones(total.shape, bool)
    ok = (total > -LONG) & (total < LONG)
    return np.where(ok, total, 0).astype(np.int64), ok.astype(bool)


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "key"))).where(F.col("rank") <= most)


def mine_hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256, chunk: int = CHUNK, label: Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding", block_rows: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each row for which the condition `anchors` holds, its best other rows of the same label, and for each of these its best rows of
    other labels whose score is within the window, in percent of the positive's score. label: default the column of that name.
    """
    least, most = window
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = stored(rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound(v)).distinct().withColumn("key", F.xxhash64("id", "label", "vector")).withColumn("d", F.size("vector")))
    packed, n_anchors, n_rows = _packed(rows, block_rows, scale, chunk)

    def best_positives(batches: Batches) -> Iterator[pa.RecordBatch]:
        last, best = None, Best(positives)
        for i, _, _, score, ok, a, r in _summed(batches):
            if last is not None and last[0] != i:
                yield from out(last, best)
                best = Best(positives)
            last = (i, a)
            ok &= (a[1][:, None] == r[1]) & (a[3][:, None] == r[3]) & ~((a[0][:, None] == r[0]) & (a[2][:, None] == r[2]))
            for slot in np.flatnonzero(ok.any(axis=1)).tolist():
                at = ok[slot]
                best.add((slot,), score[slot][at], r[0][at].astype(np.int64), r[2][at].astype(np.int64))
        if last is not None:
            yield from out(last, best)

    def out(last: tuple, best: Best) -> Iterator[pa.RecordBatch]:
        if best.held:
            slots = np.repeat([s for (s,) in best.held], [len(x[0]) for x in best.held.values()])
            score, ids, keys = (np.concatenate(x) for x in zip(*best.held.values(), strict=True))
            yield batch(i=pa.array(np.full(len(slots), last[0]), pa.int32()), slot=pa.array(slots, pa.int32()), id=ids, key=keys, score=score)

    near = _tiles(packed, n_anchors, n_rows, True).repartition("i", "j").sortWithinPartitions("i", "j", "k").transform(mapped, best_positives, "i int, slot int, id long, key long, score long")
    near = stored(_ranked(near, ["i", "slot"], positives))
    # to each tile of an anchor block the positives of its anchors, at most ANCHORS * positives of them
    asked = near.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("slot", "rank", "id", "score"))).alias("asked")).select("i", F.explode(F.sequence(F.lit(0), F.lit(max(n_rows - 1, 0)))).alias("j"), F.lit(-1).alias("k"), "asked")

    def best_negatives(batches: Batches) -> Iterator[pa.RecordBatch]:
        last, best = None, Best(negatives)
        for i, _, want, score, ok, a, r in _summed(batches):
            if last is not None and last[0] != i:
                yield from windows(last, best)
                best = Best(negatives)
            last = (i, a)
            ok &= (a[1][:, None] != r[1]) & (a[3][:, None] == r[3])
            for x in want or ():
                line, p = score[x["slot"]], x["score"]
                at = np.flatnonzero(ok[x["slot"]] & (line >= -(-least * p // 100)) & (line <= most * p // 100))
                if len(at):
                    best.add((x["slot"], x["rank"], x["id"], p), line[at], r[0][at].astype(np.int64), r[2][at].astype(np.int64))
        if last is not None:
            yield from windows(last, best)

    def windows(last: tuple, best: Best) -> Iterator[pa.RecordBatch]:
        if best.held:
            name = np.repeat(np.array(list(best.held), np.int64), [len(x[0]) for x in best.held.values()], axis=0)
            score, ids, keys = (np.concatenate(x) for x in zip(*best.held.values(), strict=True))
            yield batch(i=pa.array(np.full(len(ids), last[0]), pa.int32()), slot=pa.array(name[:, 0], pa.int32()), p=pa.array(name[:, 1], pa.int32()), anchor_id=last[1][0][name[:, 0]].astype(np.int64), positive_id=name[:, 2], positive_score=name[:, 3], id=ids, key=keys, score=score)

    far = _tiles(packed, n_anchors, n_rows, False).unionByName(asked, allowMissingColumns=True)
    far = far.repartition("i", "j").sortWithinPartitions("i", "j", "k").transform(mapped, best_negatives, "i int, slot int, p int, anchor_id long, positive_id long, positive_score long, id long, key long, score long")
    return _ranked(far, ["i", "slot", "p"], negatives).select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
