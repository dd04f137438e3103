"""Substring dedup: removes the words covered by `window` consecutive words that also start in a document with a smaller doc_id.

Segments (see segments.py) bring windows that may be equal together. Each shard holds one copy of its segments in a compressed
FM-index, and the segments of all documents are streamed through it backwards: matching statistics tell how many words from each place
on occur in the index, and the intervals of those that reach the window are reported; the least doc_id in such an interval decides.
Words are told apart by their bytes.

Defined results: a null text has no words; a null doc_id comes after all others; rows that share a doc_id are one document in the
order of documents, so they take nothing from each other; an empty table gives an empty table; other columns are not read, so
their names cannot clash. Words are kept unchanged and joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, batch, mapped, ragged, stored, texts, utf8, words
from .fm_index import FMIndex
from .segments import Units, repeated_segments, verdicts
from .suffix_dedup import covered, spans_of, with_spans


def word_units(column: pa.Array) -> Units:
    """The words of each row; their bytes are those of the word and a space."""
    data, off = utf8(column)
    h, s, e, rows = words(data, off)
    at = np.r_[0, np.cumsum(e - s + 1)]
    raw = np.r_[data, np.uint8(32)][ragged(s, e - s + 1)]
    raw[at[1:] - 1] = 32
    return Units(h, rows, raw, at)


def least_documents(m: np.ndarray, n: np.ndarray, doc: np.ndarray, contents: list[bytes], window: int) -> list[list[tuple[int, int, int]]]:
    """Of each segment the runs of its windows with the least document in which they start."""
    number: dict[bytes, int] = {}
    streams = [np.array([number.setdefault(w, len(number) + 2) for w in c.split(b" ")[:-1]], np.int64) for c in contents]
    sizes = np.array([len(x) for x in streams])
    stream, first = np.concatenate(streams), np.cumsum(sizes) - sizes
    text = np.ones(int(sizes.sum()) + len(contents), np.int64)
    text[ragged(np.cumsum(sizes + 1) - sizes - 1, sizes)] = stream
    index = FMIndex(text, window, np.repeat(doc, sizes + 1))
    length, low, _ = index.matching_statistics(stream, np.r_[0, np.cumsum(sizes)])
    at = np.flatnonzero(length >= window)  # the intervals that are reported
    value, row = index.least_of(low[at]), np.repeat(np.arange(len(n)), sizes)[at]
    new = np.flatnonzero(np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else at
    out: list[list[tuple[int, int, int]]] = [[] for _ in contents]
    for a, z in zip(new.tolist(), np.r_[new[1:], len(at)].tolist(), strict=True):
        out[row[a]].append((int(at[a] - first[row[a]]), z - a, int(value[a])))
    return out


def substring_dedup(docs: DataFrame, window: int = 50, gram: int = 24, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, key, n_words, n_removed, kept (the remaining words) and kept_sha256 of every row of docs."""
    base = texts(docs, id_column, text_column)
    segs = repeated_segments(base, word_units, window, gram, across_rows=True)
    distinct = stored(segs.groupBy("m", "h", "g", "n").agg(F.min("doc_id").alias("d")))
    found = stored(verdicts(distinct, base, word_units, window, gram, lambda m, n, d, c: least_documents(m, n, d, c, window), "d", F.min, every=True))
    spans = spans_of(segs, found, lambda value, doc: value < doc)

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8(b.column("text"))
            _, s, e, rows = words(data, off)
            s, e, raw = s.tolist(), e.tolist(), data.tobytes()
            listed = b.column("spans")
            values, at = listed.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.r_[0, listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])
            removed, kept = [], []
            for k in range(b.num_rows):
                n = int(rows[k + 1] - rows[k])
                gone = covered(values[at[k] : at[k + 1]], window, n) if at[k + 1] > at[k] else []
                stay = [0, *(x for r in gone for x in r), n]
                kept.append(b" ".join(raw[s[i] : e[i]] for a, z in zip(stay[::2], stay[1::2], strict=True) for i in range(int(rows[k]) + a, int(rows[k]) + z)))
                removed.append(sum(z - a for a, z in gone))
            yield batch(doc_id=b.column("doc_id"), key=b.column("key"), n_words=np.diff(rows).astype(np.int64), n_removed=pa.array(removed, pa.int64()), kept=pa.array(kept, pa.binary()).cast(pa.string()), kept_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()))

    return with_spans(base, spans).transform(mapped, cut, "doc_id long, key long, n_words long, n_removed long, kept string, kept_sha256 string")
