"""Parts that the corpus operators share: tables in the shared folder, bounded tables merged over all tasks, words and hashes of Arrow batches.

Everything here works on whole columns of Arrow batches, so that no row passes through the Python interpreter on its own.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

U64 = np.uint64
Batches = Iterable[pa.RecordBatch]
Mapper = Callable[[Batches], Iterator[pa.RecordBatch]]
#: An odd base of the polynomial hashes; odd numbers have an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Hashes of byte values: drawn once from a fixed seed.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: White space between words: 0x20 and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Maps A-Z to a-z and leaves the other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of more bytes are hashed one by one: long regular words can have equal polynomial hashes modulo 2**64, whatever the base.
LONG_WORD = 64
#: Bytes that one step works on at once; bounds the memory of a Python worker.
SLAB = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a folder of this machine, in local mode only."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        got = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


_PLACES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def stored(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: cuts the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes a table that `stored` wrote, once nothing will read it again."""
    if path := _PLACES.pop(df, None):
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that go to Python, in the same way for all operators, which cut them further by themselves."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def cut_batches(batches: Batches, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many rows, and of at most about so many bytes unless one row alone has more."""
    for b in batches:
        if b.num_rows <= rows and b.nbytes <= size:
            yield b
            continue
        each = np.full(b.num_rows, 64, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
                each += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total, a = np.cumsum(each), 0
        while a < b.num_rows:
            z = max(a + 1, min(a + rows, int(np.searchsorted(total, size + (total[a - 1] if a else 0), "right"))))
            yield b.slice(a, z - a)
            a = z


def mapped(df: DataFrame, mapper: Mapper, schema: str | StructType, rows: int = 1000, size: int = 4 << 20) -> DataFrame:
    """df.mapInArrow over batches of at most so many rows and bytes. Its workers give memory back: they live on and would hold
    what one large batch once needed."""
    small_batches(df.sparkSession)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from mapper(cut_batches(batches, rows, size))
        finally:
            ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text and key: what the operators read. Null texts are empty; key tells apart rows that share a doc_id.

    Rows that are equal in both have the same key and get the same result; other columns, whatever their names, are not read.
    """
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return picked.withColumn("key", F.xxhash64("doc_id", "text"))


# Arrow batches


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    a = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"").cast(pa.large_binary())
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and a.buffers()[2].size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def longs(column: pa.Array, null: int = (1 << 63) - 1) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


# hashes

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        a = np.full(max(n, 1 << 16), base & ((1 << 64) - 1), np.uint64)
        a[0] = 1
        got = _POWERS[base] = np.multiply.accumulate(a)
    return got[:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """p[i] is the polynomial hash of the first i values, modulo 2**64; len(values) + 1 of them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the values in [start, end): equal contents give equal hashes wherever they stand."""
    return mix((prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start])


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xA24BAED4963EE407)
    return h ^ (h >> U64(32))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and end bytes of the words of all rows, and the offsets of the rows in these. Words never cross rows."""
    space = IS_SPACE[data]
    starts = ~space
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True  # a row begins; of an empty last row it is beyond the data
    ends = starts.copy()
    if len(data):
        starts[1:] &= space[:-1] | first[1 : len(data)]
        ends[:-1] &= space[1:] | first[1 : len(data)]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, off)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the words at ascending places. Works through the bytes in slabs that end between words."""
    h, k = np.empty(len(s), np.uint64), 0
    while k < len(s):
        j = max(k + 1, int(np.searchsorted(e, s[k] + SLAB, "right")))
        at = s[k]
        if e[k] - at <= SLAB:
            p = prefix_hashes(BYTE_VALUES[data[at : e[j - 1]]])
            h[k:j] = span_hashes(p, s[k:j] - at, e[k:j] - at)
        k = j
    for k in np.flatnonzero(e - s > LONG_WORD).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[s[k] : e[k]], 20240229)
    return h


def words(data: np.ndarray, off: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows: their hashes, first bytes and end bytes, and the offsets of the rows in these."""
    s, e, rows = word_spans(data, off)
    return word_hashes(LOWER[data] if lower else data, s, e), s, e, rows


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start as many as its length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - first, lengths)


# bounded tables, merged over all tasks

#: Values in one slice of a merged table.
SLICE_BYTES = 1 << 18


def slices_of(table: np.ndarray) -> pa.RecordBatch:
    raw = table.view(np.uint8)
    n = range(0, len(raw), SLICE_BYTES)
    return batch(slice=pa.array(range(len(n)), pa.int32()), blob=pa.array([raw[i : i + SLICE_BYTES].tobytes() for i in n], pa.binary()))


def merged(parts: DataFrame, dtype: type, how: str) -> np.ndarray:
    """One table of bounded size from the slices (slice, blob) that every task made: summed or united bit by bit.

    Slices meet by their number in many tasks, each of which keeps one table per slice; the driver gets the merged table once.
    """
    join = {"sum": np.add, "or": np.bitwise_or}[how]

    def unite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                one = np.frombuffer(blob, dtype)
                held[k] = join(held[k], one) if k in held else one.copy()
        if held:
            yield batch(slice=pa.array(list(held), pa.int32()), blob=pa.array([x.tobytes() for x in held.values()], pa.binary()))

    got = parts.repartition(12, "slice").transform(mapped, unite, "slice int, blob binary").collect()
    return np.frombuffer(b"".join(bytes(r.blob) for r in sorted(got, key=lambda r: r.slice)), dtype)


#: Bits of a filter for one key, and the most bits of a filter: 32 MB. Larger sets make the filter weaker, not the result.
BITS_EACH, MOST_BITS = 16, 1 << 28


def _bits(n: int) -> int:
    return 1 << min(MOST_BITS.bit_length() - 1, max(13, (BITS_EACH * n - 1).bit_length()))


def filled(keys: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """A Bloom filter with some hashes: a new one for them, or one that had others."""
    table = np.zeros(_bits(len(keys)) // 8, np.uint8) if table is None else table
    for at in _probes(keys, len(table) * 8):
        np.bitwise_or.at(table, at >> U64(3), (U64(1) << (at & U64(7))).astype(np.uint8))
    return table


def hash_filter(keys: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of n long keys, of bounded size, made by all tasks; only saves work, since exact joins follow."""
    bits = _bits(n)

    def fill(batches: Batches) -> Iterator[pa.RecordBatch]:
        table = None
        for b in batches:
            if b.num_rows:
                table = filled(longs(b.column(0)).view(np.uint64), np.zeros(bits // 8, np.uint8) if table is None else table)
        if table is not None:
            yield slices_of(table)

    got = merged(keys.transform(mapped, fill, "slice int, blob binary"), np.uint8, "or")
    return got if len(got) else np.zeros(bits // 8, np.uint8)


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h & U64(bits - 1), (h >> U64(34)) & U64(bits - 1)


def may_hold(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold: all that it was given and a few others."""
    a, b = _probes(h, len(table) * 8)
    found = (table[a >> U64(3)] >> (a & U64(7)).astype(np.uint8)) & (table[b >> U64(3)] >> (b & U64(7)).astype(np.uint8)) & np.uint8(1)
    return found.astype(bool)


# groups of rows in sorted partitions


def by_key(batches: Iterable[pa.RecordBatch], column: str, most_rows: int, most_bytes: int = 64 << 20) -> Iterator[tuple[pa.Table, bool]]:
    """Whole groups of a sorted partition, many small ones at once: (rows, whether the last group goes on).

    Only a group beyond most_rows or most_bytes is cut, and is then marked; every other table ends where a group ends.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < most_rows and sum(x.nbytes for x in held) < most_bytes:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        k = t.column(column).combine_chunks().to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield t.slice(0, cut), False
            t = t.slice(cut)
        elif t.num_rows >= most_rows or t.nbytes >= most_bytes:
            yield t, True
            t = t.slice(t.num_rows)
        held = t.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks(), False


def parts_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
