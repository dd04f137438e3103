"""Repeated windows of a corpus, found exactly without moving the corpus.

A window is `window` consecutive units (bytes or words). Its anchor is the run of `gram` units inside it with the least hash;
equal windows have equal anchors at equal places. Consecutive windows of a row that share an anchor form a segment, so the
corpus is a list of segments, and windows can only be equal between segments of one anchor:

1. anchors are counted over all rows, and a bounded filter of those that occur again is made;
2. only segments of these anchors are kept, as 128-bit digests of their contents; equal segments are counted together, before and
   after the shuffle;
3. one copy of each different segment goes to the shards, by its anchor, where an index (a suffix array or an FM-index) tells which
   windows of one segment occur in another; the segments of an anchor that has very many are cut by what they share beside it first;
4. the verdict of each different segment goes back to its rows.

Hashes of anchors only bring segments together. That segments are equal rests on the digest (XXH3, 128 bits, of the bytes themselves);
that windows of different segments are equal is seen in the contents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BITS_EACH, INVERSE, MOST_BITS, U64, Batches, batch, filled, hash_filter, longs, mapped, may_hold, mix, parts_for, powers, prefix_hashes, ragged, stored

#: Low bits of a sliding minimum that hold the place, so that one array gives both; slabs are shorter than that.
PLACE_BITS = 24


#: Units that are hashed at once: their arrays stay in a core's cache.
PIECE = 1 << 18


def pieces(lengths: np.ndarray, window: int, limit: int | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (row, from, to) with at most PIECE (or `limit`) units: whole rows; longer rows are cut so that each window lies in one piece."""
    limit = limit or PIECE
    held: list[tuple[int, int, int]] = []
    size = 0
    for row in np.flatnonzero(lengths >= window):
        n = int(lengths[row])
        for a in range(0, n - window + 1, limit - window + 1):
            b = min(n, a + limit)
            if held and size + b - a > limit:
                yield held
                held, size = [], 0
            held.append((int(row), a, b))
            size += b - a
    if held:
        yield held


def segments(values: np.ndarray, bounds: np.ndarray, window: int, gram: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the units between bounds: first window, number of windows and anchor hash of every segment."""
    n, width = len(values), window - gram + 1
    p = prefix_hashes(values)
    g = mix((p[gram:] - p[: n - gram + 1]) * powers(INVERSE, n + 1)[: n - gram + 1] ^ U64(salt))
    mask = U64((1 << PLACE_BITS) - 1)
    low = (g & ~mask) | np.arange(len(g), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
    place = (low & mask).astype(np.int64)
    valid = np.zeros(n + 1, np.int8)
    has = bounds[1:] - bounds[:-1] >= window
    np.add.at(valid, bounds[:-1][has], 1)
    np.add.at(valid, bounds[1:][has] - window + 1, -1)
    valid = np.cumsum(valid[: len(place)], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    end = valid.copy()
    end[:-1] &= (place[1:] != place[:-1]) | ~valid[1:]
    s, e = np.flatnonzero(new), np.flatnonzero(end) + 1
    return s, e - s, g[place[s]]


class Units:
    """The units of some texts: their hashes, the offsets of the rows in these, and the bytes of each (from at[k] to at[k + 1])."""

    def __init__(self, values: np.ndarray, off: np.ndarray, raw: np.ndarray, at: np.ndarray | None):
        self.values, self.off, self.raw, self.at = values, off, raw, at

    def places(self, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
        if self.at is not None:
            start, end = self.at[start], self.at[end]
        return zip(start.tolist(), end.tolist(), strict=True)

    def digests(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Two 64-bit halves of the digest of the units in each [start, end)."""
        raw = memoryview(np.ascontiguousarray(self.raw))
        return np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[a:z]) for a, z in self.places(start, end)]), np.int64).reshape(-1, 2)

    def contents(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        return pa.array([self.raw[a:z].tobytes() for a, z in self.places(start, end)], pa.binary())


def scan(u: Units, window: int, gram: int, salt: int = 0) -> Iterator[tuple]:
    """(rows, first units in the row, windows, anchors) of the segments of some texts."""
    for group in pieces(np.diff(u.off), window):
        bounds = np.cumsum([0, *(z - a for _, a, z in group)])
        part = np.concatenate([u.values[u.off[r] + a : u.off[r] + z] for r, a, z in group]) if len(group) > 1 else u.values[u.off[group[0][0]] + group[0][1] : u.off[group[0][0]] + group[0][2]]
        s, c, m = segments(part, bounds, window, gram, salt)
        k = np.searchsorted(bounds, s, "right") - 1
        rows, froms = np.array([x[0] for x in group]), np.array([x[1] for x in group])
        yield rows[k], s - bounds[k] + froms[k], c, m


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def repeated_segments(docs: DataFrame, units, window: int, gram: int, across_rows: bool) -> DataFrame:
    """key, doc_id, start, n, m, h, g of all segments whose anchor m occurs again: anywhere, or across_rows under another doc_id."""

    def anchors(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = longs(b.column("doc_id"))
            for rows, _, _, m in scan(units(b.column("text")), window, gram):
                order = np.lexsort((ids[rows], m)) if across_rows else np.argsort(m)
                m, d = m[order], ids[rows][order]
                first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]]) if len(m) else np.zeros(0, int)
                last = np.r_[first[1:], len(m)] - 1 if len(m) else first
                if across_rows:
                    yield batch(m=_signed(m[first]), a=d[first], z=d[last])
                else:
                    yield batch(m=_signed(m[first]), a=np.zeros(len(first), np.int64), z=(last > first).astype(np.int64))

    counted = docs.transform(mapped, anchors, "m long, a long, z long").groupBy("m")
    again = counted.agg(F.min("a").alias("a"), F.max("z").alias("z")) if across_rows else counted.agg((F.count("a") + F.sum("z")).alias("z"), F.lit(1).alias("a"))
    again = stored(again.where("z > a").select("m"))
    n = again.count()
    table = docs.sparkSession.sparkContext.broadcast(hash_filter(again, n))

    def kept(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, u = longs(b.column("doc_id")), longs(b.column("key")), units(b.column("text"))
            for rows, s, c, m in scan(u, window, gram):
                ok = may_hold(table.value, m)
                rows, s, c, m = (x[ok] for x in (rows, s, c, m))
                at = u.off[rows] + s
                d = u.digests(at, at + c + window - 1)
                yield batch(key=keys[rows], doc_id=ids[rows], start=s.astype(np.int64), n=c.astype(np.int32), m=_signed(m), h=d[:, 0], g=d[:, 1])

    found = docs.transform(mapped, kept, "key long, doc_id long, start long, n int, m long, h long, g long", size=2 << 20)
    if n * BITS_EACH > MOST_BITS:  # the filter lets much through
        found = found.join(again, "m", "left_semi")
    return stored(found)


#: Segments that one task remembers, so that it sends one copy of each.
REMEMBERED = 1 << 20


def segment_texts(docs: DataFrame, units, window: int, gram: int, anchors: DataFrame) -> DataFrame:
    """h, g, content of one copy of every different segment of the given anchors (m), and perhaps of others; content is binary."""
    table = docs.sparkSession.sparkContext.broadcast(hash_filter(anchors, anchors.count()))

    def found(batches: Batches) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            u = units(b.column("text"))
            for rows, s, c, m in scan(u, window, gram):
                ok = np.flatnonzero(may_hold(table.value, m))
                at = (u.off[rows] + s)[ok]
                end = at + c[ok] + window - 1
                d = u.digests(at, end)
                new = []
                for k, x in enumerate(map(tuple, d.tolist())):
                    if x not in seen:
                        seen.add(x)
                        new.append(k)
                if len(seen) > REMEMBERED:
                    seen.clear()
                yield batch(h=d[new, 0], g=d[new, 1], content=u.contents(at[new], end[new]))

    return docs.transform(mapped, found, "h long, g long, content binary", size=2 << 20)


#: Different segments of one anchor that one index takes; those of an anchor with more are cut.
HOT = 512


def verdicts(distinct: DataFrame, docs: DataFrame, units, window: int, gram: int, resolve, weight: str, combine, every: bool) -> DataFrame:
    """h, g, runs of each different segment; distinct has m, h, g, n and the column named by weight; combine aggregates weights of equal
    segments.

    resolve(m, windows, weights, contents) gives for each row the runs (first window, windows, value) it finds. Unless every segment
    is wanted, anchors with one segment only get no index: all their windows have that segment's own weight, which the caller reads
    from distinct.
    """
    anchors = stored(distinct.groupBy("m").agg(F.count("h").alias("k")).where(f"k > {0 if every else 1}").select("m"))
    wanted = distinct if every else distinct.join(anchors, "m", "left_semi")
    rows = segment_texts(docs, units, window, gram, anchors).dropDuplicates(["h", "g"]).join(wanted, ["h", "g"])
    rows = stored(rows.select("m", "h", "g", "n", F.lit(-1).alias("at"), weight, "content"))
    return _indexed(rows, rows.groupBy("m").agg(F.count("h").alias("k")), units, window, gram, gram, resolve, weight, combine, every)


#: Anchors that the driver may make a filter of by itself: half a MB of them.
FEW = 1 << 16


def _filter(anchors: DataFrame) -> Broadcast | None:
    """A filter of some anchors for all tasks; None if there are none."""
    few = anchors.limit(FEW + 1).toArrow()
    if not few.num_rows:
        return None
    keys = few.column("m").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return anchors.sparkSession.sparkContext.broadcast(filled(keys) if len(keys) <= FEW else hash_filter(anchors, anchors.count()))


def _among(rows: DataFrame, table: Broadcast, there: bool) -> DataFrame:
    """The rows whose anchor is in a filter, or isn't: no row moves, however many share an anchor. What the filter holds beside its
    anchors is cut or kept like them, so that each row is in one of the two."""

    def found(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(may_hold(table.value, _m(b)) == there))

    return rows.transform(mapped, found, rows.schema)


def _m(b: pa.RecordBatch) -> np.ndarray:
    return longs(b.column("m")).view(np.uint64)


def anchor_places(u: Units, n: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Where in each segment of n windows its anchor begins: the least gram that all its windows hold, the first of equal ones."""
    p = prefix_hashes(u.values)
    g = mix((p[gram:] - p[: len(p) - gram]) * powers(INVERSE, len(p))[: len(p) - gram])
    mask = U64((1 << PLACE_BITS) - 1)
    low = (g & ~mask) | np.arange(len(g), dtype=np.uint64)
    count = window - gram + 2 - n
    at = ragged(u.off[:-1] + n - 1, count)
    return (np.minimum.reduceat(low[at], np.cumsum(count) - count) & mask).astype(np.int64) - u.off[:-1]


def halves(n: np.ndarray, at: np.ndarray, window: int, core: int) -> list[tuple[np.ndarray, ...]]:
    """Of segments of n windows that all hold `core` units at a place: (segments, first window, windows, place and size of a larger core).

    A window has window - core units beside the core, so half of them or more on its left, or else on its right; its side tells which
    larger core it holds. Equal windows are on one side and hold equal cores.
    """
    half = (window - core + 1) // 2
    left = np.clip(at - half + 1, 0, n)
    a, b = np.flatnonzero(left > 0), np.flatnonzero(left < n)
    return [(a, np.zeros(len(a), np.int64), left[a], (at - half)[a]), (b, left[b], (n - left)[b], at[b])]


def _indexed(rows: DataFrame, tally: DataFrame, units, window: int, gram: int, core: int, resolve, weight: str, combine, every: bool) -> DataFrame:
    """h, g, runs. All windows of an anchor share `core` units. Where its segments are too many for one index, they are cut in two by
    the side on which their windows go on, and meet again by the larger core that they share there: two rows for each, and so on until
    few share a core. At last the core is the window, and all that share it are one. Only what is really shared is cut again."""
    hot = None if core >= window else _filter(tally.where(F.col("k") > HOT).select("m"))
    if hot is None:
        return _shards(rows, resolve, weight)
    half = (window - core + 1) // 2

    def split(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, g, n, at, w = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "g", "n", "at", weight))
            u = units(b.column("content"))
            at = anchor_places(u, n, window, gram) if core == gram else at
            raw = memoryview(np.ascontiguousarray(u.raw))
            for side, (r, start, count, place) in enumerate(halves(n, at, window, core)):
                begin = u.off[r] + start
                end, mid = begin + count + window - 1, u.off[r] + place
                m = np.array([xxhash.xxh3_64_intdigest(raw[x:y], 2 * core + side) for x, y in u.places(mid, mid + core + half)], np.uint64)
                d = u.digests(begin, end)
                yield batch(h=h[r], g=g[r], start=start.astype(np.int32), m=_signed(m), part_h=d[:, 0], part_g=d[:, 1] ^ _signed(m), n=count.astype(np.int32), at=(place - start).astype(np.int32), **{weight: w[r]}, content=u.contents(begin, end))

    cut = stored(mapped(_among(rows, hot, True), split, f"h long, g long, start int, m long, part_h long, part_g long, n int, at int, {weight} long, content binary", size=1 << 20))
    parts = stored(cut.groupBy("m", F.col("part_h").alias("h"), F.col("part_g").alias("g"), "n", "at").agg(combine(weight).alias(weight), F.min("content").alias("content")))
    inner = stored(parts.groupBy("m").agg(F.count("h").alias("k"), F.max(weight).alias("most")))
    if not every:  # a segment that is alone, and once, has no equal windows
        shared = _filter(inner.where("k > 1 or most > 1").select("m"))
        parts = parts.limit(0) if shared is None else _among(parts, shared, True)
    found = _indexed(parts, inner.select("m", "k"), units, window, gram, core + half, resolve, weight, combine, every).withColumnsRenamed({"h": "part_h", "g": "part_g"})
    runs = cut.select("h", "g", "start", "part_h", "part_g").join(found, ["part_h", "part_g"]).select("h", "g", "start", F.explode(F.arrays_zip("first", "count", "value")).alias("r"))
    whole = runs.groupBy("h", "g").agg(F.collect_list(F.struct((F.col("start") + F.col("r.first")).alias("first"), F.col("r.count"), F.col("r.value"))).alias("r"))
    back = whole.select("h", "g", *(F.col(f"r.{c}").alias(c) for c in ("first", "count", "value")))
    return _shards(_among(rows, hot, False), resolve, weight).unionByName(back)


def _shards(rows: DataFrame, resolve, weight: str) -> DataFrame:
    schema = "h long, g long, first array<int>, count array<int>, value array<long>"

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, h, g, n, w, content in grouped(batches, weight):
            runs = resolve(m, n, w, content)
            yield batch(h=h, g=g, first=pa.array([[r[0] for r in x] for x in runs], pa.list_(pa.int32())), count=pa.array([[r[1] for r in x] for x in runs], pa.list_(pa.int32())), value=pa.array([[r[2] for r in x] for x in runs], pa.list_(pa.int64())))

    cols = ["m", "h", "g", "n", weight, "content"]
    return rows.select(*cols).repartition(4 * parts_for(rows.sparkSession), "m").sortWithinPartitions("m", "h", "g").transform(mapped, shards, schema)


#: Bytes of segments that one index covers; the different segments of one anchor, HOT at most, stay together, so that it may cover more.
INDEX_BYTES = 2 << 20


def grouped(batches: Iterable[pa.RecordBatch], weight: str) -> Iterator[tuple]:
    """Whole anchors of a sorted partition, as many as fit one index."""
    held: list[tuple] = []
    size = 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("m", "h", "g", "n", weight, "content")), strict=True):
            if size > INDEX_BYTES and row[0] != held[-1][0]:
                yield _columns(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield _columns(held)


def _columns(rows: list[tuple]) -> tuple:
    m, h, g, n, w, content = zip(*rows, strict=True)
    return np.array(m), np.array(h), np.array(g), np.array(n), np.array(w), list(content)
