"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a context tree over the bytes before it, up to `depth` of them. Every node of a
tree holds a Krichevsky-Trofimov estimate, and context-tree weighting mixes the estimates of all depths. The block probabilities
have a closed form in the counts, so the trees are learned from counts alone, in any order: gathering is one pass over all training
texts that counts runs of depth + 1 bytes. The weighting goes bottom up: subtrees below two context bytes are weighted where their
counts lie, the two levels above (at most 256 + 65,536 contexts) on the driver. A context of two bytes with more than SUBTREE runs is
cut into subtrees below three bytes, or more; their sums are added up by an aggregation for the nodes above them. Scoring reads the
trees as they are after all training texts. A context that training never saw ends its branch, which then counts as the node above.

Texts are lower-cased (A-Z); a text begins after DEPTH zero bytes and ends with one. Beside the model's score stands the base: the
probability of the text's words and its end under add-one counts of the training tokens.

The estimates of runs are sent to tasks as tables of at most PART entries, with one pass over the texts for each; a model of more than
MOST_PASSES tables is not sent but joined. The most frequent words are one table of at most PART entries; the others are joined.

Defined results: a null text is empty: its tokens are the end alone; a null doc_id belongs to training; rows are scored on their
own, so repeated rows get the same score (and count as often in training); without training rows every decision is even and the
base counts no tokens; an empty table gives an empty table; other columns are not read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, Batches, batch, by_key, longs, mapped, parts_for, ragged, stored, texts, utf8, words

DEPTH = 5
#: Entries of one table that is sent to tasks; with its free places it takes up to 67 MB.
PART = 2_750_000
#: Passes over the texts, at most, with one table each; beyond these all runs of the texts are joined to the model by one shuffle,
#: which moves some 30 bytes for each byte of text. SALTS: into so many partitions one run may go there.
MOST_PASSES, SALTS = 16, 8
#: Bytes or words that a task holds before it sums them up.
HOLD = 1 << 20
#: Different runs under all context bytes but one, at most; and those of one subtree that is weighted at once, unless it has these.
MOST_RUNS = SUBTREE = 1 << 16
GRAMS, WORDS, TOKENS = 0, 1, 2


def grams(data: np.ndarray, off: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The runs of depth + 1 bytes that end at each byte and at the end of each row, oldest byte first, and the rows' offsets."""
    n = np.diff(off)
    at = np.cumsum(n + depth + 1) - n - 1
    padded = np.zeros(int(n.sum()) + (depth + 1) * len(n), np.uint64)
    padded[ragged(at, n)] = LOWER[data]
    places = ragged(at, n + 1)
    run = np.zeros(len(padded), np.uint64)
    for k in range(depth + 1):
        run[depth:] |= padded[depth - k : len(padded) - k] << U64(8 * k)
    return run[places], np.r_[0, np.cumsum(n + 1)]


class Tally:
    """Sums of counts by key, of bounded size but for the different keys of one task."""

    def __init__(self):
        self.keys, self.counts, self.held, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, n: int) -> None:
        for k in range(0, len(keys), HOLD):
            part = np.sort(keys[k : k + HOLD])
            new = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            self.held.append((part[new], np.diff(np.r_[new, len(part)]) * n))
            self.size += len(new)
            if self.size > HOLD:
                self._sum()

    def _sum(self) -> None:
        if self.held:
            keys = np.concatenate([self.keys, *(k for k, _ in self.held)])
            counts = np.concatenate([self.counts, *(c for _, c in self.held)])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.keys, self.counts, self.held, self.size = keys[new], np.add.reduceat(counts, new), [], 0

    def rows(self, kind: int) -> Iterator[pa.RecordBatch]:
        self._sum()
        for k in range(0, len(self.keys), 1 << 18):
            key = self.keys[k : k + (1 << 18)].view(np.int64)
            yield batch(kind=pa.array(np.full(len(key), kind), pa.int32()), key=key, n=self.counts[k : k + (1 << 18)])


# weighting


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of x > 0, by Stirling's series above 8."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log probability of a block of bits under the Krichevsky-Trofimov estimate."""
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1)


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (keys[new], *(np.add.reduceat(v[order], new) for v in values))


class Level:
    """Nodes of one depth: key (context bytes, latest first, then the bits of the byte so far after a leading one), counts, the log
    probability of all that lies below, and the weight of the node's own estimate."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_block(zeros, ones)
        if below is None:
            self.weight, self.log = np.ones(len(keys)), own
        else:
            self.weight, self.log = 0.5 * (1 + np.tanh((own - below) / 2)), np.logaddexp(own, below) - np.log(2)

    def parents(self) -> tuple[np.ndarray, ...]:
        up = self.keys >> U64(16) << U64(8) | self.keys & U64(255)
        return summed(up, self.zeros, self.ones, self.log)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def mixed(self, keys: np.ndarray, bit: np.ndarray, below: np.ndarray | None, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The probability of each bit, given that of the level below where it is known; and whether this level knows the node."""
        at, here = self.find(keys)
        if not len(self.keys):
            return np.full(len(keys), 0.5), here
        n = np.where(bit, self.ones[at], self.zeros[at])
        own = (n + 0.5) / (self.zeros[at] + self.ones[at] + 1)
        p = own if below is None else np.where(known, self.weight[at] * own + (1 - self.weight[at]) * below, own)
        return np.where(here, p, 0.5), here


def decisions(run: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run the eight decisions of its byte: context (latest byte first), bits so far, bit; each of shape (8, runs)."""
    context = np.zeros(len(run), np.uint64)
    for k in range(1, depth + 1):
        context |= (run >> U64(8 * k) & U64(255)) << U64(8 * (depth - k))
    j = np.arange(8, dtype=np.uint64)[:, None]
    byte = (run & U64(255))[None, :]
    return np.broadcast_to(context, (8, len(run))), U64(1) << j | byte >> U64(8) - j, (byte >> U64(7) - j & U64(1)).astype(bool)


def key_at(context: np.ndarray, bits: np.ndarray, skipped: int) -> np.ndarray:
    """Nodes of contexts without their `skipped` oldest bytes."""
    return context >> U64(8 * skipped) << U64(8) | bits


def levels(run: np.ndarray, n: np.ndarray, top: int, depth: int = DEPTH) -> dict[int, Level]:
    """The weighted levels from depth up to top of the runs that occur n times in training."""
    run, n = run[n > 0], n[n > 0]
    context, bits, bit = decisions(run, depth)
    count = np.broadcast_to(n, bit.shape).ravel()
    flat = bit.ravel()
    out = {depth: Level(*summed(key_at(context, bits, 0).ravel(), np.where(flat, 0, count), np.where(flat, count, 0)), None)}
    for d in range(depth - 1, top - 1, -1):
        out[d] = Level(*out[d + 1].parents())
    return out


def log10_of(run: np.ndarray, found: dict[int, Level], depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each run's last byte after the others."""
    context, bits, bit = decisions(run, depth)
    p = known = None
    for d in range(depth, -1, -1):
        p, known = found[d].mixed(key_at(context, bits, depth - d).ravel(), bit.ravel(), p, known)
    return np.log10(p).reshape(bit.shape).sum(axis=0)


def learned(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, value: log10 of the probability of every run, for counts (key, n) of all runs; those not seen in training have n = 0."""
    spark = counts.sparkSession

    def last(d: int) -> Column:
        return F.shiftright(F.col("key"), 8).bitwiseAND(F.lit((1 << 8 * d) - 1))

    # the latest context bytes decide where a subtree lies: two of them, or as many more as keep it within bounds; all but one always do
    runs, place, cut = counts.select("key", "n"), last(2).bitwiseOR(F.lit(2 << 56)), 2
    for d in range(2, depth - 1):
        within = runs if d == 2 else runs.where(F.col(f"large{d - 1}").isNotNull())
        # at most one for each SUBTREE of all runs
        large = within.groupBy(last(d).alias(f"large{d}")).count().where(F.col("count") > SUBTREE).drop("count").collect()
        if not large:
            break
        runs = runs.join(F.broadcast(spark.createDataFrame(large, f"large{d} long")), last(d) == F.col(f"large{d}"), "left")
        cut = d + 1
        place = F.when(F.col(f"large{d}").isNotNull(), last(d + 1).bitwiseOR(F.lit(d + 1 << 56))).otherwise(place)
    placed = stored(runs.select("key", "n", place.alias("place")).repartition(parts_for(spark), "place").sortWithinPartitions("place", "key"))
    placed = placed.repartition(parts_for(spark), "place").sortWithinPartitions("place", "key")

    def whole(batches: Batches) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Depth, runs and counts of whole subtrees, many small ones of one depth at once."""
        for t, goes_on in by_key(batches, "place", MOST_RUNS + 1, 1 << 40):
            assert not goes_on, "a subtree of all context bytes but one has at most MOST_RUNS runs"
            run, n, at = longs(t.column("key").combine_chunks()).view(np.uint64), longs(t.column("n").combine_chunks()), longs(t.column("place").combine_chunks()) >> 56
            for d in np.unique(at).tolist():
                yield d, run[at == d], n[at == d]

    def subtrees(batches: Batches) -> Iterator[pa.RecordBatch]:
        """What the subtrees add to the nodes above them."""
        for d, run, n in whole(batches):
            keys, zeros, ones, log = levels(run, n, d, depth)[d].parents()
            yield batch(depth=pa.array(np.full(len(keys), d), pa.int32()), key=keys.view(np.int64), zeros=zeros, ones=ones, log=log)

    nodes = mapped(placed, subtrees, "depth int, key long, zeros long, ones long, log double", rows=1 << 16)
    # of two context bytes the sums by the latest one: at most 65,280 nodes; as decimals, since sums of doubles depend on their order
    nodes = nodes.groupBy("depth", "key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(F.col("log").cast("decimal(38,12)")).cast("double").alias("log"))
    got = nodes.toArrow().combine_chunks()

    def column(c: str) -> np.ndarray:
        return got.column(c).to_numpy() if got.num_rows else np.zeros(0, np.float64 if c == "log" else np.int64)

    def of(d: int) -> tuple[np.ndarray, ...]:
        here = column("depth") == d
        return column("key").view(np.uint64)[here], column("zeros")[here], column("ones")[here], column("log")[here]

    def united(*some: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return summed(*(np.concatenate(c) for c in zip(*some, strict=True)))

    # nodes above the subtrees: those of two or more bytes are above large subtrees only
    upper: dict[int, Level] = {}
    for d in range(cut - 1, 0, -1):
        upper[d] = Level(*united(of(d + 1), *([upper[d + 1].parents()] if d + 1 in upper else [])))
    upper[0] = Level(*upper[1].parents())
    sent = spark.sparkContext.broadcast(upper)

    def estimates(batches: Batches) -> Iterator[pa.RecordBatch]:
        for d, run, n in whole(batches):
            found = sent.value | levels(run, n, d, depth)
            for k in range(0, len(run), 1 << 16):
                yield batch(key=run[k : k + (1 << 16)].view(np.int64), value=log10_of(run[k : k + (1 << 16)], found, depth))

    return mapped(placed, estimates, "key long, value double", rows=1 << 16)


# tables that score


class Table:
    """An open table from 64-bit keys to values; zero stands for no key, and its value is kept apart."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (3 * len(keys) // 2).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys, self.values = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, values.dtype)
        zero = np.flatnonzero(keys == 0)
        self.zero = values[zero[0]] if len(zero) else None
        keys, values = keys[keys != 0], values[keys != 0]
        todo, place = np.arange(len(keys)), self._place(keys)
        while len(todo):
            free = self.keys[place] == 0
            self.keys[place[free]] = keys[todo[free]]
            put = self.keys[place] == keys[todo]
            self.values[place[put]] = values[todo[put]]
            todo, place = todo[~put], (place[~put] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, missing) -> np.ndarray:
        place = self._place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.values[place], missing)
        todo = np.flatnonzero((held != keys) & (held != 0))
        while len(todo):
            place[todo] = (place[todo] + 1) & self.mask
            held = self.keys[place[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[place[todo[hit]]]
            todo = todo[~hit & (held != 0)]
        zero = np.flatnonzero(keys == 0)
        if len(zero):
            out[zero] = missing if self.zero is None else self.zero
        return out


def table_of(entries: DataFrame, dtype: type) -> Table:
    t = entries.toArrow().combine_chunks()
    return Table(t.column("key").to_numpy().astype(np.int64).view(np.uint64), t.column("value").to_numpy().astype(dtype)) if t.num_rows else Table(np.zeros(0, np.uint64), np.zeros(0, dtype))


def score_texts(docs: DataFrame, held_out, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, model: bool = True) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row of docs.

    held_out: a condition on the column doc_id; rows for which it holds are not learned from. depth: bytes of context, 3 to 7. model:
    whether the tree is learned; else score and bits_per_byte are null, and only words are counted.
    """
    if not 3 <= depth <= 7:
        raise ValueError("depth must be 3 to 7")
    base = texts(docs, id_column, text_column).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    spark = docs.sparkSession
    small = {"rows": 300, "size": 1 << 20}  # each byte takes several words of 8 bytes on its way

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        runs, seen, tokens = Tally(), Tally(), 0
        for b in batches:
            data, off = utf8(b.column("text"))
            out = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            if model:
                run, at = grams(data, off, depth)
                for part, n in ((~out, 1), (out, 0)):
                    runs.add(run[ragged(at[:-1][part], np.diff(at)[part])], n)
            h, _, _, rows = words(data, off, lower=True)
            train = h[ragged(rows[:-1][~out], np.diff(rows)[~out])]
            seen.add(train, 1)
            tokens += len(train) + int((~out).sum())
        yield from runs.rows(GRAMS)
        yield from seen.rows(WORDS)
        yield batch(kind=pa.array([TOKENS], pa.int32()), key=pa.array([0], pa.int64()), n=pa.array([tokens], pa.int64()))

    counts = stored(mapped(base, count, "kind int, key long, n long", **small).groupBy("kind", "key").agg(F.sum("n").alias("n")))
    about = {r.kind: r for r in counts.groupBy("kind").agg(F.count("key").alias("k"), F.sum("n").alias("n"), F.count(F.when(F.col("n") > 1, 1)).alias("often")).collect()}
    size = lambda kind, field: about[kind][field] if kind in about else 0
    train_tokens = size(TOKENS, "n")
    ends = train_tokens - size(WORDS, "n")  # one for each training row
    vocabulary = size(WORDS, "k") + (ends > 0)
    # words that occur at least so many times are in one table of bounded size; the others are joined
    known = counts.where(F.col("kind") == WORDS).select("key", F.col("n").alias("value"))
    least, often = 2, size(WORDS, "often")
    while often > PART:
        least *= 2
        often = known.where(F.col("value") >= least).count()
    word_table = spark.sparkContext.broadcast(table_of(known.where(F.col("value") >= least), np.int64))

    runs = stored(learned(counts.where(F.col("kind") == GRAMS), depth)) if model else None
    parts = max(1, -(-size(GRAMS, "k") // PART))
    passes = parts <= MOST_PASSES
    run_table = spark.sparkContext.broadcast(table_of(runs if parts == 1 else _part(runs, parts, 0), np.float64) if passes and model else None)

    def read(batches: Batches) -> Iterator[pa.RecordBatch]:
        """One row for each row of docs: what the run table and the word table give; and the words that the table may not have."""
        for b in batches:
            data, off = utf8(b.column("text"))
            h, _, _, rows = words(data, off, lower=True)
            c = word_table.value.get(h, 0).astype(np.int64)
            out = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            owner = np.repeat(np.arange(b.num_rows), np.diff(rows))
            if least == 2:
                c[(c == 0) & ~out[owner]] = 1  # a training row's own words are in training
            add = lambda x: np.bincount(owner, x, b.num_rows)
            n = np.diff(rows)
            logs = add(np.log10(c + 1.0)) + (np.log10(ends + 1.0))
            known = add(c > 0).astype(np.int64) + (ends > 0)
            rare = np.flatnonzero(c == 0)
            asked = [h[rare[a:z]].view(np.int64) for a, z in _spans(owner[rare], b.num_rows)]
            yield batch(doc_id=b.column("doc_id"), key=b.column("key"), held_out=b.column("held_out"), n_bytes=np.diff(off), n_tokens=n.astype(np.int64) + 1, n_known=known, logs=logs, score=_run_scores(data, off, run_table.value, depth), rare=pa.array(asked, pa.list_(pa.int64())))

    rows = stored(mapped(base, read, "doc_id long, key long, held_out boolean, n_bytes long, n_tokens long, n_known long, logs double, score double, rare array<long>", **small))
    asked = rows.where("size(rare) > 0").dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.explode("rare").alias("word")).groupBy("doc_id", "key", "word").agg(F.count("word").alias("k"))
    found = asked.join(known.where(F.col("value") < least).withColumnRenamed("key", "word"), "word").groupBy("doc_id", "key").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("value") + 1.0)).alias("more_logs"))

    def with_same(found: DataFrame, how: str) -> DataFrame:
        """both, joined to what was found for its rows; a null doc_id equals a null doc_id."""
        found = found.withColumnsRenamed({"doc_id": "same_id", "key": "same_key"})
        return both.join(found, (F.col("key") == F.col("same_key")) & F.col("doc_id").eqNullSafe(F.col("same_id")), how).drop("same_id", "same_key")

    both = rows.drop("rare")
    both = with_same(found, "left").withColumn("k", F.coalesce("k", F.lit(0))).withColumn("more_logs", F.coalesce("more_logs", F.lit(0.0)))
    if not passes:
        both = with_same(_joined_scores(base, runs, depth, small), "inner").withColumn("score", F.col("more")).drop("more")
    for k in range(1, parts if passes else 1):
        table = spark.sparkContext.broadcast(table_of(_part(runs, parts, k), np.float64))
        more = _pass(base, table, depth, small).groupBy("doc_id", "key").agg(F.max("score").alias("more"))
        both = with_same(more, "inner").withColumn("score", F.col("score") + F.col("more")).drop("more")
    scale = float(np.log10(train_tokens + vocabulary + 1))
    if not model:
        both = both.withColumn("score", F.lit(None).cast("double"))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("k")).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * scale).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def _part(runs: DataFrame, parts: int, k: int) -> DataFrame:
    return runs.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == k)


def _run_scores(data: np.ndarray, off: np.ndarray, table: Table | None, depth: int) -> np.ndarray:
    """Of each row the log10 of the runs that the table holds."""
    if table is None or len(off) == 1:
        return np.zeros(len(off) - 1)
    run, at = grams(data, off, depth)
    return np.add.reduceat(table.get(run, 0.0), at[:-1])


def _pass(base: DataFrame, table, depth: int, small: dict) -> DataFrame:
    """doc_id, key, score of the runs that a table (a broadcast) holds."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(doc_id=b.column("doc_id"), key=b.column("key"), score=_run_scores(*utf8(b.column("text")), table.value, depth))

    return mapped(base, run, "doc_id long, key long, score double", **small)


def _joined_scores(base: DataFrame, runs: DataFrame, depth: int, small: dict) -> DataFrame:
    """doc_id, key, more: the score of every different row, by one join of all runs; those of a row are counted before it.

    Runs meet their estimates in the partitions of the run; where one run is in very many rows, its rows are dealt over SALTS
    partitions, and so is its estimate.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            run, at = grams(*utf8(b.column("text")), depth)
            row = np.repeat(np.arange(b.num_rows), np.diff(at))
            order = np.lexsort((run, row))
            run, row = run[order], row[order]
            new = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (row[1:] != row[:-1])]) if len(run) else np.zeros(0, np.int64)
            for k in range(0, len(new), 1 << 17):
                s = new[k : k + (1 << 17)]
                e = np.r_[new[k + 1 : k + (1 << 17)], new[k + (1 << 17)] if k + (1 << 17) < len(new) else len(run)]
                where = pa.array(row[s])
                yield batch(doc_id=b.column("doc_id").take(where), key=b.column("key").take(where), run=run[s].view(np.int64), n=e - s)

    each = mapped(base.dropDuplicates(["doc_id", "key"]), run, "doc_id long, key long, run long, n long", **small).withColumn("salt", F.pmod("key", F.lit(SALTS)))
    salted = runs.select(F.col("key").alias("run"), "value", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"))
    return each.join(salted, ["run", "salt"]).groupBy("doc_id", "key").agg(F.sum(F.col("n") * F.col("value")).alias("more"))


def _spans(owner: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    at = np.searchsorted(owner, np.arange(n + 1))
    return zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
