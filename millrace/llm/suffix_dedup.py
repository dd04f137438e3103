"""Suffix-array dedup: removes every byte covered by a string of `length` bytes that also starts anywhere else in the corpus.

Segments (see segments.py) bring windows that may be equal together; the suffix array of each group, built by linear grouping
(grouping.py), puts equal windows side by side, where they are compared byte by byte and counted.

Defined results: a null text is empty; an empty or short text loses nothing; rows with the same doc_id and text are separate
occurrences of their strings and get the same result; a null doc_id is kept as null; an empty table gives an empty table; columns
other than the id and the text are not read, so their names cannot clash. Very long texts are worked through in overlapping slabs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, Batches, batch, longs, mapped, ragged, stored, texts, utf8
from .grouping import suffix_arrays
from .segments import Units, repeated_segments, verdicts

NO_ID = (1 << 63) - 1
#: Low bits of a span that hold its number of windows; a segment never has so many.
COUNT_BITS = 22


def byte_units(column: pa.Array) -> Units:
    data, off = utf8(column)
    return Units(BYTE_VALUES[data], off, data, None)


def repeats(m: np.ndarray, n: np.ndarray, weight: np.ndarray, contents: list[bytes], length: int) -> list[list[tuple[int, int, int]]]:
    """Of each segment the runs of windows that occur twice or more among the segments of its anchor, each counted weight times."""
    sizes = np.array([len(c) for c in contents])
    at = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(contents), np.int64)
    raw = np.frombuffer(b"".join(contents), np.uint8)
    text[ragged(at, sizes)] = raw.astype(np.int64) + 1
    first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
    bounds = np.r_[at[first], len(text)]
    sa = suffix_arrays(text, bounds)
    window = np.full(len(text), -1, np.int64)  # the segment of each place where a window starts
    window[ragged(at, n)] = np.repeat(np.arange(len(n)), n)
    sa = sa[window[sa] >= 0]
    same = np.zeros(len(sa), bool)
    near = np.flatnonzero(m[window[sa[1:]]] == m[window[sa[:-1]]]) + 1
    views = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint16), length)
    for k in range(0, len(near), 1 << 15):
        part = near[k : k + (1 << 15)]
        same[part] = (views[sa[part]] == views[sa[part - 1]]).all(axis=1)
    starts = np.flatnonzero(~same)
    hits = np.zeros(len(text) + 1, bool)
    if len(starts):
        total = np.add.reduceat(weight[window[sa]], starts)
        hits[sa[np.repeat(total >= 2, np.diff(np.r_[starts, len(sa)]))]] = True
    edge = np.flatnonzero(np.diff(np.r_[False, hits].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    out: list[list[tuple[int, int, int]]] = [[] for _ in contents]
    for a, z, k in zip(begin.tolist(), end.tolist(), (np.searchsorted(at, begin, "right") - 1).tolist(), strict=True):
        out[k].append((a - int(at[k]), z - a, 1))
    return out


def covered(spans: np.ndarray, length: int, n: int) -> list[tuple[int, int]]:
    """The maximal runs of units that windows cover, from packed spans of windows."""
    a = np.sort(spans)
    begin, end = a >> COUNT_BITS, (a >> COUNT_BITS) + (a & ((1 << COUNT_BITS) - 1)) + length - 1
    end = np.maximum.accumulate(end)
    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return list(zip(begin[new].tolist(), np.minimum(end[np.r_[new[1:], len(a)] - 1], n).tolist(), strict=True))


def spans_of(segs: DataFrame, verdict: DataFrame, wanted) -> DataFrame:
    """key, id, spans: of each row the packed spans of windows whose run has a wanted value; verdict has h, g, first, count, value."""
    runs = segs.join(verdict, ["h", "g"]).select("key", "doc_id", "start", F.explode(F.arrays_zip("first", "count", "value")).alias("r"))
    packed = F.shiftleft(F.col("start") + F.col("r.first"), COUNT_BITS) + F.col("r.count")
    return runs.where(wanted(F.col("r.value"), F.col("doc_id"))).groupBy("key", F.col("doc_id").alias("id")).agg(F.collect_list(packed).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    return docs.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).join(spans, ["key", "id"], "left").select("key", "doc_id", "text", "spans")


def suffix_array_dedup(docs: DataFrame, length: int = 200, gram: int = 100, id_column: str = "doc_id", text_column: str = "text", as_text: bool = False) -> DataFrame:
    """doc_id, key, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256 of every row of docs.

    kept is binary, as a cut may go through a character; as_text makes it a string without the characters that were cut through.
    """
    base = texts(docs, id_column, text_column)
    segs = repeated_segments(base, byte_units, length, gram, across_rows=False)
    distinct = stored(segs.groupBy("m", "h", "g", "n").agg(F.count("key").alias("w")))
    found = verdicts(distinct, base, byte_units, length, gram, lambda m, n, w, c: repeats(m, n, w, c, length), "w", F.sum, every=False)
    one = lambda c, t: F.array(c.cast(t))
    whole = distinct.where("w > 1").select("h", "g", one(F.lit(0), "int").alias("first"), one(F.col("n"), "int").alias("count"), one(F.lit(1), "long").alias("value"))
    partly = found.where(F.size("first") > 0).join(distinct.where("w = 1").select("h", "g"), ["h", "g"])
    spans = spans_of(segs, whole.unionByName(partly), lambda value, _: value > 0)

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8(b.column("text"))
            listed = b.column("spans")
            values, at = listed.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.r_[0, listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])
            removed, runs, kept = [], [], []
            for k in range(b.num_rows):
                row = data[off[k] : off[k + 1]]
                gone = covered(values[at[k] : at[k + 1]], length, len(row)) if at[k + 1] > at[k] else []
                stay = [0, *(x for r in gone for x in r), len(row)]
                kept.append(b"".join(row[i:j].tobytes() for i, j in zip(stay[::2], stay[1::2], strict=True)))
                removed.append(sum(z - a for a, z in gone))
                runs.append(len(gone))
            yield batch(doc_id=b.column("doc_id"), key=b.column("key"), n_bytes=np.diff(off), n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(runs, pa.int64()), kept=pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), kept_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))

    return with_spans(base, spans).transform(mapped, cut, f"doc_id long, key long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}, kept_sha256 string")
