"""N-gram Jaccard join by prefix trees: links documents whose sets of word n-grams have a Jaccard similarity of 0.8 or more.

1. One pass counts words and n-grams in hashed tables of fixed size. How often the words of an n-gram occur, and how much more often it
   occurs than others do, gives one global order of all n-grams: rare ones first. Of equal sets only one is read on.
2. Sets that can be linked share SHARED n-grams (or all of their overlap, if that is less) among their first
   |x| - ceil(0.8 |x|) + SHARED. Each task first sends 32 bits of half as many again, which tells the n-grams that only one set has,
   and those of many sets, which are put last in the order, so that a passage that is often quoted makes no candidates; what is left
   follows as packed arrays. Under an n-gram of few sets each pair is counted whose sizes and places allow a link, and goes on if
   parities of hashed n-grams (about a bit and a half for each) don't rule it out; under one of many sets these are joined without
   counting. Outside the groups of such links there are no links; parities cut each of these groups once more.
3. Each different set of a group is stored once in a trie of ordered n-grams. A set walks the trie: branches share the overlap
   that they have in common, and a branch ends when what remains of it cannot reach the threshold. Sets that are known to be in
   one component aren't compared again. Groups beyond BLOCK_GRAMS are cut into blocks, each of which is joined with some sets of the
   whole group; then the sets that aren't in its largest component are joined with every block.

Equal sets are collapsed before anything is compared, so copies are never expanded into pairs.

Defined results: a null text is empty; a text without words has no n-grams and is linked with nothing; with fewer words than n the
whole sequence is one n-gram; rows that share a doc_id are documents of their own; a null doc_id counts as none, so that a
component of such rows alone has a null id; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Batches, batch, group_starts, hash_filter, longs, mapped, may_hold, merged, mix, parts_for, prefix_hashes, ragged, slices_of, span_hashes, stored, texts, utf8, words
from .components import connected_components

#: Bits of the counters of n-grams and of words for the global order: 3 MB in all, whatever the corpus.
GRAM_BITS, WORD_BITS = 18, 19
#: The bits of an n-gram's hash.
HASH = U64((1 << 56) - 1)
#: N-grams of all sets that one task joins.
BLOCK_GRAMS = 2_000_000
#: Sets of a large group that are joined with each of its blocks, about.
HUBS = 64
#: Sets of the largest group that parities cut; a larger one goes on as it is.
CLOSE_SETS = 50_000
#: Bytes of the prefixes in one shard, about.
SHARD_BYTES = 32 << 20
#: N-grams that two sets must share in their prefixes to be compared: one is often shared by chance, the more so the more sets there are.
SHARED = 4
#: Sets under one n-gram of which each pair is counted, and rows of a batch under one n-gram that show that it has more.
PAIRS, PAIRS_IN_BATCH = 16, 8
#: Rows under n-grams whose pairs are made at once.
PAIR_SLAB = 200_000
#: The most bits of the table of n-grams that several sets have: 32 MB. Beyond, more rows are sent, with the same result.
SHARED_BITS = 28
#: Rows of one component are joined to what is known of it in so many partitions.
SALTS = 8


def ngram_sets(column: pa.Array, size: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted different n-grams of each row, the offsets of the rows, and the hashes of all words.

    An n-gram is 56 bits of a hash; with half bits of the words (`half_bits`), 7 bits above these tell how common its words are.
    """
    h, _, _, off = words(*utf8(column), lower=True)
    n = np.diff(off)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    start = ragged(off[:-1], count)
    end = start + np.repeat(np.minimum(n, size), count)
    grams = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):  # in slabs, as the powers of the hash are kept in memory
        j = min(len(start), k + (1 << 20))
        at = start[k]
        grams[k:j] = span_hashes(prefix_hashes(h[at : end[j - 1]]), start[k:j] - at, end[k:j] - at) >> U64(8)
        k = j
    if common is not None:
        rare = np.r_[0, np.cumsum(common[(h >> U64(64 - WORD_BITS)).astype(np.int64)], dtype=np.int64)]
        grams |= np.maximum(0, 127 - (rare[end] - rare[start] >> 1)).astype(np.uint64) << U64(56)
    at = np.r_[0, np.cumsum(count)]
    for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        grams[a:z].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[at[:-1][count > 0]] = True
    total = np.r_[0, np.cumsum(new)]
    return grams[new], total[at], h


def set_ids(grams: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Equal sets have equal ids; an empty set has 0."""
    total = np.r_[U64(0), np.cumsum(mix(grams & HASH ^ U64(0x5851F42D4C957F2D)))]
    n = np.diff(off)
    ids = mix(total[off[1:]] - total[off[:-1]] + n.astype(np.uint64))
    return np.where(n > 0, ids | U64(1), U64(0))


def half_bits(counts: np.ndarray) -> np.ndarray:
    """For each counter of words, how rare they are: twice the binary logarithm of all words to these."""
    return np.rint(2 * np.log2(max(1, counts.sum(dtype=np.int64)) / np.maximum(1.0, counts))).astype(np.uint8)


def excess(counts: np.ndarray) -> np.ndarray:
    """For each counter of n-grams, how common one of them must be, on the scale of ngram_sets: by what it has beyond the mean of all
    counters and their spread; 0 where that is nothing."""
    mean = counts.mean()
    over = np.maximum(0.0, counts - mean - 6 * np.sqrt(mean) - 1)
    return np.where(over > 0, np.clip(np.rint(127 - np.log2(max(1, counts.sum(dtype=np.int64)) / np.maximum(1.0, over))), 0, 127), 0).astype(np.uint8)


def ordered(grams: np.ndarray, off: np.ndarray, over: np.ndarray) -> np.ndarray:
    """The n-grams of each row in the global order. 7 bits of a key tell how frequent it is, the lower ones which it is."""
    most = over[(grams >> U64(56 - GRAM_BITS) & U64((1 << GRAM_BITS) - 1)).astype(np.int64)].astype(np.uint64)
    return _sorted_rows(np.maximum(grams >> U64(56), most) << U64(56) | grams & HASH, grams, off)


def _sorted_rows(keys: np.ndarray, before: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Keys made from sorted ones, sorted again in each row that has changed."""
    moved = np.r_[0, np.cumsum(keys != before)]
    for k in np.flatnonzero(moved[off[:-1]] < moved[off[1:]]).tolist():
        keys[off[k] : off[k + 1]].sort()
    return keys


def parities(grams: np.ndarray, off: np.ndarray) -> pa.Array:
    """Of each set, for 64 or more hashed values, at least as many as it has n-grams, whether an odd number of its n-grams has them.

    Each n-gram that only one of two sets has changes one bit, so that the bits that differ are at most as many as these. Twice as
    many values can be folded to half as many.
    """
    n = np.diff(off)
    size = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(1, n))).astype(np.int64))
    at = np.r_[0, np.cumsum(size)]
    bit = (mix(grams & HASH) & np.repeat(size - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(at[:-1], n)
    raw = np.packbits((np.bincount(bit, minlength=at[-1]) & 1).astype(bool), bitorder="little")
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at // 8), pa.py_buffer(raw)]).cast(pa.binary())


def may_link(n: np.ndarray, m: np.ndarray, a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Which pairs of sets, of n and m n-grams and with parities a and b, may have a similarity of 0.8 or more; false only for those that haven't.

    With an overlap of 4 / 9 of n + m or more, at most (n + m) / 9 n-grams are in one of the sets only.
    """
    out = np.ones(len(a), bool)
    x, y = (np.array([len(v) for v in c], np.int64) for c in (a, b))
    for i, j in sorted(set(zip(x.tolist(), y.tolist(), strict=True))):
        some = np.flatnonzero((x == i) & (y == j))
        u, v = (np.frombuffer(b"".join(c[k] for k in some.tolist()), np.uint8).reshape(len(some), -1, min(i, j)) for c in (a, b))
        out[some] = 9 * np.bitwise_count(np.bitwise_xor.reduce(u, axis=1) ^ np.bitwise_xor.reduce(v, axis=1)).sum(axis=1, dtype=np.int64) <= n[some] + m[some]
    return out


def _folded(bits: np.ndarray) -> np.ndarray:
    """Rows of parities for half as many values."""
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def close_components(n: list[int], bits: list[bytes]) -> np.ndarray:
    """The component of each set (the number of one of its sets) by pairs of sets that may be linked (see may_link)."""
    sizes, width = np.array(n, np.int64), np.array([len(x) for x in bits])
    rest: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # sets without a component, by width: which, parities, folded
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        one = np.frombuffer(b"".join(bits[k] for k in at.tolist()), np.uint64).reshape(len(at), -1)
        rest[w] = at, one, _folded(one) if w > 8 else one[:, :0]
    label = np.full(len(sizes), -1)
    for start in range(len(sizes)):
        if label[start] >= 0:
            continue
        todo, label[start] = [start], start
        while todo:
            k = todo.pop()
            w, own = int(width[k]), np.frombuffer(bits[k], np.uint64)[None]
            for other in (w // 2, w, 2 * w):
                if other not in rest or not len(rest[other][0]):
                    continue
                at, one, half = rest[other]
                differ = np.bitwise_count((one if other <= w else half) ^ (_folded(own) if other < w else own)).sum(axis=1, dtype=np.int64)
                hit = (9 * differ <= sizes[at] + sizes[k]) & (5 * np.minimum(sizes[at], sizes[k]) >= 4 * np.maximum(sizes[at], sizes[k]))
                hit |= at == k
                if hit.any():
                    new = at[hit & (label[at] < 0)]
                    label[new] = start
                    todo += new.tolist()
                    rest[other] = at[~hit], one[~hit], half[~hit]
    return label


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, n - (4 * n + 4) // 5 + SHARED)


def told_lengths(n: np.ndarray) -> np.ndarray:
    """How many n-grams are told: what may come into the prefix when others are put last."""
    return np.minimum(n, prefix_lengths(n) * 3 // 2)


def bucket_pairs(token: np.ndarray, node: np.ndarray, size: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs u, v of different sets under each n-gram that could be linked: how many n-grams they share here, and how many they must.

    Rows are in the order of n-gram and set, each only once.
    """
    found = []
    for d in range(1, PAIRS):
        a = np.flatnonzero(token[d:] == token[:-d])
        if not len(a):
            break
        z = a + d
        fits = (size[z] <= reach[a]) & (size[a] <= reach[z])
        a, z = a[fits], z[fits]
        found.append((node[a], node[z], np.minimum(SHARED, (4 * np.maximum(size[a], size[z]) + 4) // 5)))
    if not found:
        return node[:0], node[:0], size[:0], size[:0]
    u, v, need = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((v, u))
    u, v, need = u[order], v[order], need[order]
    at = group_starts(u, v)
    return u[at], v[at], np.diff(np.r_[at, len(u)]), need[at]


def bucket_links(token: np.ndarray, node: np.ndarray, size: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links u, v that join the sets under each n-gram that could be linked there, and the rows that later links may still need.

    A pair is only asked for under its first SHARED common n-grams. With the n-gram at place i of n, the overlap is n - j at most, where
    j = max(0, i - SHARED + 1), so that the other set has at most reach = (5n - 9j) / 4 n-grams; and each must be within the reach of the other. Sets with reach >= n
    are linked to the earlier (smaller) set that reaches farthest, which is enough to join all that reach each other; a row that
    the same set outreaches isn't needed any more. Others are only linked to smaller sets.
    """
    tokens = np.unique(token, return_inverse=True)[1].astype(np.int64) << 34
    strong = reach >= size
    at = np.flatnonzero(strong)
    at = at[np.lexsort((-reach[at], tokens[at] + size[at]))]
    if not len(at):
        return node[:0], node[:0], np.ones(len(token), bool)
    base = tokens[at]
    far = np.maximum.accumulate(base + reach[at])
    grows = np.r_[True, far[1:] > far[:-1]]
    best = np.maximum.accumulate(np.where(grows, np.arange(len(at)), 0))
    before = np.r_[0, best[:-1]]
    met = np.r_[False, far[:-1] >= base[1:] + size[at][1:]]  # a farther reach of another n-gram is below base
    weak = np.flatnonzero(~strong)
    k = np.searchsorted(base + size[at], tokens[weak] + reach[weak], "right") - 1
    hit = (k >= 0) & (far[np.maximum(k, 0)] >= tokens[weak] + size[weak])
    u = np.r_[node[at[met]], node[weak[hit]]]
    v = np.r_[node[at[before[met]]], node[at[best[k[hit]]]]]
    needed = np.ones(len(token), bool)
    needed[at[~grows]] = False
    other = u != v
    return u[other], v[other], needed


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links and the least node of its component."""
    nodes, index = np.unique(np.r_[a, b], return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        least = np.minimum(label[a], label[b])
        for x in (a, b):
            np.minimum.at(label, x, least)
            np.minimum.at(label, old[x], least)
        label = label[label]
        if (label == old).all():
            return nodes, nodes[label]


class Trie:
    """Ordered sets as a tree of token runs; sets[k] is an array of local token numbers, in the global order."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        self.sets, self.runs, self.below, self.leaves, self.depth, self.sizes = sets, [np.zeros(0, np.int32)], [[]], [[]], [0], [[1 << 60, 0]]
        path, last = [0], np.zeros(0, np.int32)
        for k in order:
            s = sets[k]
            m = min(len(s), len(last))
            differs = np.flatnonzero(s[:m] != last[:m])
            shared = int(differs[0]) if len(differs) else m
            while self.depth[path[-1]] > shared:
                node = path.pop()
                if self.depth[path[-1]] < shared:  # a run is cut where the new set leaves it
                    cut = shared - self.depth[path[-1]]
                    upper = self._add(self.runs[node][:cut], shared)
                    self.runs[node] = self.runs[node][cut:]
                    parent = path[-1]
                    self.below[parent][-1] = upper
                    self.below[upper] = [node]
                    path.append(upper)
            if len(s) > shared:
                node = self._add(s[shared:], len(s))
                self.below[path[-1]].append(node)
                path.append(node)
            self.leaves[path[-1]].append(k)
            last = s
        for node in self._bottom_up():
            sizes = [len(sets[k]) for k in self.leaves[node]] + [x for c in self.below[node] for x in self.sizes[c]]
            self.sizes[node] = [min(sizes), max(sizes)] if sizes else [1 << 60, 0]

    def _add(self, run: np.ndarray, depth: int) -> int:
        self.runs.append(run)
        self.below.append([])
        self.leaves.append([])
        self.depth.append(depth)
        self.sizes.append([1 << 60, 0])
        return len(self.runs) - 1

    def _bottom_up(self) -> list[int]:
        seen, todo = [], [0]
        while todo:
            node = todo.pop()
            seen.append(node)
            todo += self.below[node]
        return seen[::-1]

    def search(self, query: np.ndarray, skip, mark: np.ndarray) -> list[int]:
        """The sets with a Jaccard similarity of 0.8 or more, without those for which skip holds. mark is all False before and after."""
        mark[query] = True
        n, found, todo = len(query), [], [(0, 0)]
        while todo:
            node, overlap = todo.pop()
            for c in self.below[node]:
                least, most = self.sizes[c]
                if 5 * most < 4 * n or 5 * n < 4 * least:
                    continue
                if not self.below[c] and all(skip(k) for k in self.leaves[c]):
                    continue
                run, depth = self.runs[c], self.depth[c]
                need = -(-4 * (n + max(least, -(-4 * n // 5))) // 9)  # overlap for the least set that still fits
                got, left = overlap, most - depth + len(run)
                head = len(run) // 4
                if head > 16:  # what remains of the branch bounds the overlap
                    got += int(np.count_nonzero(mark[run[:head]]))
                    if got + left - head < need:
                        continue
                    run, left = run[head:], left - head
                got += int(np.count_nonzero(mark[run]))
                if got + left - len(run) < need:
                    continue
                for k in self.leaves[c]:
                    if not skip(k) and 9 * got >= 4 * (n + len(self.sets[k])):
                        found.append(k)
                if self.below[c]:
                    todo.append((c, got))
        mark[query] = False
        return found


def join_group(keys: list[np.ndarray]) -> list[int]:
    """The component of each set (the number of its first set), by walks through one trie."""
    flat = np.concatenate(keys)
    local = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    del flat
    at = np.cumsum([0, *map(len, keys)])
    sets = [local[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]
    trie, mark = Trie(sets), np.zeros(int(local.max()) + 1, bool)
    root = list(range(len(sets)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    parts = len(sets)
    for k in range(len(sets)):
        if parts == 1:
            break
        own = find(k)
        for j in trie.search(sets[k], lambda j, own=own: find(j) == own, mark):
            a, b = find(k), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                parts -= 1
    return [find(k) for k in range(len(sets))]


def prefix_tree_join(docs: DataFrame, size: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, key, n_shingles, component_id, group of every row of docs, by links of 0.8 or more.

    group is the same for all rows of a component, whatever their ids, and null for texts without words.
    """
    base = texts(docs, id_column, text_column)
    spark = docs.sparkSession

    cut = 1 << GRAM_BITS

    def counted(batches: Batches) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cut + (1 << WORD_BITS), np.uint32)
        for b in batches:
            grams, off, h = ngram_sets(b.column("text"), size)
            table[:cut] += np.bincount((grams >> U64(56 - GRAM_BITS)).astype(np.int64), minlength=cut).astype(np.uint32)
            table[cut:] += np.bincount((h >> U64(64 - WORD_BITS)).astype(np.int64), minlength=1 << WORD_BITS).astype(np.uint32)
            none = pa.nulls(b.num_rows, pa.int32())
            yield batch(doc_id=b.column("doc_id"), key=b.column("key"), set=set_ids(grams, off).view(np.int64), n=np.diff(off), bits=parities(grams, off), slice=none, blob=pa.nulls(b.num_rows, pa.binary()))
        s = slices_of(table)
        none = pa.nulls(s.num_rows, pa.int64())
        yield batch(doc_id=none, key=none, set=none, n=none, bits=pa.nulls(s.num_rows, pa.binary()), slice=s.column(0), blob=s.column(1))

    first = stored(base.transform(mapped, counted, "doc_id long, key long, set long, n long, bits binary, slice int, blob binary"))
    rows = first.where("slice is null").select("doc_id", "key", "set", "n")
    counts = merged(first.where("slice is not null").select("slice", "blob"), np.uint32, "sum")
    counts = counts if len(counts) else np.zeros(cut + (1 << WORD_BITS), np.uint32)
    tables = spark.sparkContext.broadcast((excess(counts[:cut]), half_bits(counts[cut:])))
    # of equal sets, the row with the least key is read, and a few others that the filter may hold
    one_each = stored(rows.where("n > 0").groupBy("set").agg(F.min("key").alias("key"), F.min("n").alias("n")))
    differing, entries = one_each.agg(F.count("key"), F.sum(F.floor(F.col("n") / 5) + SHARED)).first()
    entries = entries or 0
    readers = spark.sparkContext.broadcast(hash_filter(one_each.select("key"), differing))

    def different_sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """N-grams in the global order and their offsets, the ids of the sets, and the rows that hold the different sets of a batch."""
        over, common = tables.value
        grams, off, _ = ngram_sets(b.column("text").filter(pa.array(may_hold(readers.value, longs(b.column("key")).view(np.uint64)))), size, common)
        ids = set_ids(grams, off)
        _, one = np.unique(ids, return_index=True)
        return ordered(grams, off, over), off, ids, one[np.diff(off)[one] > 0]

    # as many shards as the prefixes need
    shards = max(2 * parts_for(spark), -(-entries * 24 // SHARD_BYTES))
    slice_bits = max(8, (entries * 4 // SHARD_BYTES).bit_length())
    bits = max(slice_bits + 6, min(max(SHARED_BITS, slice_bits + 6), int(2 * entries).bit_length()))

    def short(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, off, _, one = different_sets(b)
            h = np.sort(mix(keys[ragged(off[one], told_lengths(np.diff(off)[one]))]))
            if not len(h):
                continue
            h = h[np.r_[np.ones(PAIRS + 1, bool), h[PAIRS + 1 :] != h[: -PAIRS - 1]][: len(h)]]  # no more than tell that there are many
            slices = (h >> U64(64 - slice_bits)).astype(np.int64)
            at = group_starts(slices)
            rest = (h >> U64(32 - slice_bits)).astype("<u4")
            yield batch(slice=pa.array(slices[at], pa.int32()), blob=pa.array([rest[a:z].tobytes() for a, z in zip(at, np.r_[at[1:], len(h)], strict=True)], pa.binary()))

    def repeated(batches: Batches) -> Iterator[pa.RecordBatch]:
        def table_of(held: list[bytes]) -> bytes:
            h = np.sort(np.frombuffer(b"".join(held), "<u4"))
            found = np.zeros(1 << (bits - slice_bits), bool), np.zeros(1 << (bits - 3 - slice_bits), bool)
            found[0][h[1:][h[1:] == h[:-1]] >> np.uint32(32 - (bits - slice_bits))] = True
            found[1][h[PAIRS:][h[PAIRS:] == h[:-PAIRS]] >> np.uint32(32 - (bits - 3 - slice_bits))] = True
            return np.packbits(np.concatenate(found), bitorder="little").tobytes()

        last, held = None, []
        for b in batches:
            for s, blob in zip(b.column("slice").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if s != last and held:
                    yield batch(slice=pa.array([last], pa.int32()), blob=pa.array([table_of(held)], pa.binary()))
                    held = []
                last = s
                held.append(blob)
        if held:
            yield batch(slice=pa.array([last], pa.int32()), blob=pa.array([table_of(held)], pa.binary()))

    # as many slices as keep one small; each is united in one task, and the driver gets their bits
    told = base.transform(mapped, short, "slice int, blob binary").repartition(max(12, parts_for(spark)), "slice").sortWithinPartitions("slice")
    few_bytes, many_bytes = 1 << (bits - slice_bits - 3), 1 << (bits - slice_bits - 6)
    several_have, many_have = np.zeros((1 << slice_bits, few_bytes), np.uint8), np.zeros((1 << slice_bits, many_bytes), np.uint8)
    for r in told.transform(mapped, repeated, "slice int, blob binary").collect():
        several_have[r.slice] = np.frombuffer(r.blob, np.uint8, few_bytes)
        many_have[r.slice] = np.frombuffer(r.blob, np.uint8, many_bytes, few_bytes)
    kept = spark.sparkContext.broadcast((several_have.ravel(), many_have.ravel()))
    del several_have, many_have

    def told_of(keys: np.ndarray, k: int) -> np.ndarray:
        """For keys without the upper bit, whether several sets have them (k is 0) or many (1)."""
        bit = mix(keys) >> U64(64 - bits + 3 * k)
        return (kept.value[k][bit >> U64(3)] >> (bit & U64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)

    def first_grams(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The first n-grams of the different sets of a batch that other sets may have: these, their sets, the sizes of the sets, and the places."""
        keys, off, ids, one = different_sets(b)
        if not len(one):
            return keys[:0], ids[:0], off[:0], off[:0]
        n = np.diff(off)[one]
        last = np.repeat(keys[off[one] + told_lengths(n) - 1], prefix_lengths(n))  # beyond these none was told
        ours, off = keys[ragged(off[one], n)], np.r_[0, np.cumsum(n)]
        ours = _sorted_rows(ours | told_of(ours, 1).astype(np.uint64) << U64(63), ours, off)
        p = prefix_lengths(n)
        token = ours[ragged(off[:-1], p)]
        plain = token & ~(U64(1) << U64(63))
        some = np.flatnonzero((plain > last) | told_of(plain, 0))
        return token[some], np.repeat(ids[one], p)[some], np.repeat(n, p)[some], ragged(np.zeros(len(p), np.int64), p)[some]

    def prefixes(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, node, sizes, place = first_grams(b)
            if not len(token):
                continue
            reach = (5 * sizes - 9 * np.maximum(0, place - SHARED + 1)) // 4
            # n-grams of many sets: what is outreached here isn't sent
            _, index, k = np.unique(token, return_inverse=True, return_counts=True)
            many = k[index] > PAIRS_IN_BATCH
            needed = np.ones(len(token), bool)
            u, v, needed[many] = bucket_links(token[many], node[many], sizes[many], reach[many])
            packed = np.stack([token, node, (sizes << 32 | reach).astype(np.uint64) | many.astype(np.uint64) << U64(63)], axis=1)[needed]
            token = token[needed]
            shard = (mix(token) % U64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            packed, at = packed[order], np.searchsorted(shard[order], np.arange(shards + 1))
            some = np.flatnonzero(np.diff(at))
            blobs = [np.ascontiguousarray(packed[at[k] : at[k + 1]]).tobytes() for k in some]
            links = np.stack(local_components(u, v), axis=1) if len(u) else np.zeros((0, 2), np.uint64)
            yield batch(shard=pa.array([*some, int(shard[0])], pa.int32()), links=pa.array([False] * len(some) + [True]), blob=pa.array([*blobs, np.ascontiguousarray(links).tobytes()], pa.binary()))

    def grouped(batches: Batches) -> Iterator[pa.RecordBatch]:
        shard, held, links = None, [], []
        for b in batches:
            for s, is_link, blob in zip(b.column("shard").to_pylist(), b.column("links").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if s != shard and shard is not None:
                    yield from _shard_links(held, links)
                    held, links = [], []
                shard = s
                (links if is_link else held).append(np.frombuffer(blob, np.uint64).reshape(-1, 2) if is_link else _unpack(blob))
        if shard is not None:
            yield from _shard_links(held, links)

    sent = base.transform(mapped, prefixes, "shard int, links boolean, blob binary").repartition(shards, "shard").sortWithinPartitions("shard", "links")
    found = sent.transform(mapped, grouped, "u long, v long, k int, need int").groupBy("u", "v").agg(F.sum("k").alias("k"), F.min("need").alias("need"))
    found = stored(found.where("k >= need").select("u", "v", "need"))

    def bits_of(sets: DataFrame) -> DataFrame:
        """set, n, bits of the different sets, and of a few others."""
        which = spark.sparkContext.broadcast(hash_filter(sets, sets.count()))

        def picked(batches: Batches) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(may_hold(which.value, longs(b.column("set")).view(np.uint64))))

        return first.where("slice is null and n > 0").select("set", "n", "bits").transform(mapped, picked, "set long, n long, bits binary").dropDuplicates(["set"])

    def close(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fits = may_link(longs(b.column("n")), longs(b.column("m")), b.column("a").to_pylist(), b.column("b").to_pylist())
            yield b.select(["u", "v"]).filter(pa.array(fits))

    def cut_groups(batches: Batches) -> Iterator[pa.RecordBatch]:
        def parts(group: int, sets: list[int], n: list[int], bits: list[bytes]) -> pa.RecordBatch:
            ids = np.array(sets, np.int64)
            label = close_components(n, bits) if len(sets) <= CLOSE_SETS else np.zeros(len(sets), np.int64)
            several = np.bincount(label, minlength=len(sets))[label] > 1
            return batch(set=ids[several], group=ids[label[several]])

        last, held = None, ([], [], [])
        for b in batches:
            for g, *row in zip(*(b.column(c).to_pylist() for c in ("group", "set", "n", "bits")), strict=True):
                if g != last and held[0]:
                    yield parts(last, *held)
                    held = ([], [], [])
                last = g
                for x, y in zip(held, row, strict=True):
                    x.append(y)
        if held[0]:
            yield parts(last, *held)

    pairs = found.where("need > 0").select("u", "v")
    bits_each = bits_of(pairs.select(F.col("u").alias("set")).unionByName(pairs.select(F.col("v").alias("set"))).distinct())
    both = pairs.join(bits_each.select(F.col("set").alias("u"), "n", F.col("bits").alias("a")), "u").join(bits_each.select(F.col("set").alias("v"), F.col("n").alias("m"), F.col("bits").alias("b")), "v")
    near = connected_components(found.where("need = 0").select("u", "v").unionByName(both.select("u", "v", "n", "m", "a", "b").transform(mapped, close, "u long, v long")))
    group = stored(near.select(F.col("u").alias("set"), F.col("v").alias("group")).unionByName(near.select(F.col("v").alias("set"), F.col("v").alias("group")).distinct()))
    group = bits_of(group.select("set")).join(group, "set").select("group", "set", "n", "bits").repartition("group").sortWithinPartitions("group", "set")
    group = stored(group.transform(mapped, cut_groups, "set long, group long"))
    wanted = spark.sparkContext.broadcast(hash_filter(group.select("set"), group.count()))

    def contents(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, off, ids, one = different_sets(b)
            one = one[may_hold(wanted.value, ids[one])]
            if len(one):
                yield batch(set=ids[one].view(np.int64), keys=pa.array([keys[off[k] : off[k + 1]].tobytes() for k in one], pa.binary()))

    weight = group.join(one_each.select("set", "n"), "set")
    sized = stored(weight.groupBy("group").agg((F.floor((F.sum("n") - 1) / BLOCK_GRAMS) + 1).cast("int").alias("blocks"), F.sum("n").alias("grams"), F.count("n").alias("sets")))
    most, grams_in_all = sized.agg(F.max("blocks"), F.sum("grams")).first()
    tasks = max(2 * parts_for(spark), -(-(grams_in_all or 0) // (4 * BLOCK_GRAMS)))
    member = group.join(sized, "group").withColumn("own", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))

    def joined(batches: Batches) -> Iterator[pa.RecordBatch]:
        last, ids, keys = None, [], []
        for b in batches:
            for g, k, s, blob in zip(*(b.column(c).to_pylist() for c in ("group", "block", "set", "keys")), strict=True):
                if last is not None and (g, k) != last:
                    yield from _group_links(ids, keys)
                    ids, keys = [], []
                last = (g, k)
                ids.append(s)
                keys.append(np.frombuffer(blob, np.uint64))
        if ids:
            yield from _group_links(ids, keys)

    def compared(members: DataFrame) -> DataFrame:
        """Links u, v between the sets that share a group and a block, by components of these."""
        held = base.transform(mapped, contents, "set long, keys binary").dropDuplicates(["set"]).join(members.select("set", "group", "block"), "set")
        return stored(held.select("group", "block", "set", "keys").repartition(tasks, "group", "block").sortWithinPartitions("group", "block", "set").transform(mapped, joined, "u long, v long"))

    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    hub = F.pmod(F.xxhash64("group", "set"), F.greatest(F.lit(1), F.floor(F.col("sets") / HUBS))) == 0
    links = compared(member.withColumn("block", F.explode(F.when(hub, every).otherwise(F.array("own")))) if (most or 0) > 1 else member.withColumn("block", F.lit(0)))
    if (most or 0) > 1:
        links = connected_components(links)
        parts = member.where("blocks > 1").join(links.select(F.col("u").alias("set"), F.col("v").alias("root")), "set", "left").withColumn("root", F.coalesce("root", "set"))
        largest = parts.groupBy("group", "root").agg(F.count("set").alias("k")).groupBy("group").agg(F.max_by("root", F.struct("k", "root")).alias("main"))
        outside = stored(parts.join(largest, "group").where("root <> main").join(one_each.select("set", "n"), "set").select("set", "group", "n"))
        # those outside are cut into blocks as well, each of which meets each block of the group
        again = stored(outside.groupBy("group").agg((F.floor((F.sum("n") - 1) / BLOCK_GRAMS) + 1).cast("int").alias("others")))
        if again.first() is not None:
            place = F.pmod(F.xxhash64("set", F.lit(1)), F.col("others")).cast("int")
            met = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda i: i * F.col("blocks") + F.col("own"))
            meets = F.when(F.col("out"), F.transform(every, lambda j: place * F.col("blocks") + j)).otherwise(F.array().cast("array<int>"))
            rest = member.join(again, "group").join(outside.select("set", F.lit(True).alias("out")), "set", "left").withColumn("block", F.explode(F.array_distinct(F.concat(met, meets))))
            links = connected_components(links.unionByName(compared(rest)))
    salt = F.pmod("key", F.lit(SALTS)).alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt")
    labelled = rows.select("*", salt).join(links.select(F.col("u").alias("set"), F.col("v").alias("root"), salts), ["set", "salt"], "left").withColumn("root", F.coalesce("root", "set"))
    least = labelled.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("key").alias("k"))
    several = least.where("k > 1").select("root", "least", salts)
    out = labelled.join(several, ["root", "salt"], "left")
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("root")).alias("group"))


def _unpack(blob: bytes) -> np.ndarray:
    """Rows of n-gram, set, and in one: whether it has many sets (1 bit), size and reach. 24 bytes each."""
    return np.frombuffer(blob, np.uint64).reshape(-1, 3)


def _shard_links(held: list[np.ndarray], links: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """u, v of possible links, with the n-grams that they share here and those that they must share in all."""
    u, v = [x[:, 0] for x in links], [x[:, 1] for x in links]
    if held:
        t = np.concatenate(held)
        t = t[np.lexsort((t[:, 1], t[:, 0]))]
        at = group_starts(t[:, 0])
        many = np.logical_or.reduceat(t[:, 2] >> U64(63) > 0, at)
        t = np.repeat(many, np.diff(np.r_[at, len(t)])).astype(np.uint64)[:, None] * (U64(1) << U64(63)) * np.array([0, 0, 1], np.uint64) | t
        t = t[group_starts(t[:, 0], t[:, 1])]  # copies of a set
        at = group_starts(t[:, 0])
        k = np.diff(np.r_[at, len(t)])
        many = np.repeat((k > PAIRS) | (t[at, 2] >> U64(63) > 0), k)
        size, reach = (t[:, 2] >> U64(32) & U64(0x7FFFFFFF)).astype(np.int64), (t[:, 2] & U64(0xFFFFFFFF)).astype(np.int64)
        a, b, _ = bucket_links(t[many, 0], t[many, 1], size[many], reach[many])
        u.append(a)
        v.append(b)
        few = np.flatnonzero(~many & (np.repeat(k, k) > 1))
        x = 0
        while x < len(few):
            y = min(len(few), x + PAIR_SLAB)
            y = min(len(few), int(np.searchsorted(t[few, 0], t[few[y - 1], 0], "right")))
            one = few[x:y]
            a, b, shared, need = bucket_pairs(t[one, 0], t[one, 1], size[one], reach[one])
            if len(a):
                yield batch(u=a.view(np.int64), v=b.view(np.int64), k=shared.astype(np.int32), need=need.astype(np.int32))
            x = y
    u, v = np.concatenate(u), np.concatenate(v)
    if len(u):
        node, root = local_components(u, v)
        far = node != root
        yield batch(u=node[far].view(np.int64), v=root[far].view(np.int64), k=np.full(far.sum(), SHARED, np.int32), need=np.zeros(far.sum(), np.int32))


def _group_links(ids: list[int], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    root = join_group(keys)
    far = [k for k, r in enumerate(root) if r != k]
    if far:
        yield batch(u=pa.array([ids[k] for k in far], pa.int64()), v=pa.array([ids[root[k]] for k in far], pa.int64()))
