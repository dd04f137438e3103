"""Benchmark decontamination by pigeonhole edit matching.

An item within an error budget of k edits of some stretch of a document keeps at least one of its k + 1 pieces unchanged. All
pieces of all items are looked up in each document at once by an Aho-Corasick automaton; around each hit the item is verified
with Myers' bit-parallel edit distance, so the result is exact for the budget.

Texts are compared in lower case (A-Z) with runs of white space (0x20, 0x09 to 0x0D) as one space, trimmed.

Items that are equal after this are looked for once, under one key, and reported under the id of each of them.

Defined results: a null or empty text matches nothing; items with a null or empty text are left out; an item with a null id is
reported with it, and one that is repeated with the same id once; rows that share a doc_id are documents of their own; an empty table
of documents or items gives no matches; other columns are not read. Documents are searched whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Batches, batch, mapped, texts, utf8

#: Bytes of items that are sent to every task, about; larger benchmarks are searched in parts of this size.
PART_BYTES = 4 << 20
#: Items whose ids are sent to every task; more are joined by a shuffle.
FEW_ITEMS = 100_000


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def pieces_of(item: bytes, budget: int) -> list[tuple[int, bytes]]:
    """budget + 1 pieces of nearly equal length with their places."""
    n, parts = len(item), budget + 1
    at = [n * k // parts for k in range(parts + 1)]
    return [(a, item[a:z]) for a, z in zip(at[:-1], at[1:], strict=True)]


class Pattern:
    """Myers' bit-vectors of one item."""

    def __init__(self, item: bytes):
        self.n, self.masks = len(item), {}
        for k, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << k

    def distance(self, text: bytes, budget: int) -> int | None:
        """The least edit distance between the item and any stretch of text, or None beyond the budget."""
        full, top = (1 << self.n) - 1, 1 << (self.n - 1)
        plus, minus, score, best = full, 0, self.n, self.n
        masks = self.masks
        for c in text:
            eq = masks.get(c, 0)
            x = eq | minus
            diagonal = ((((eq & plus) + plus) ^ plus) | eq) & full
            up = minus | (full & ~(diagonal | plus))
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up = up << 1 & full
            down = down << 1 & full
            plus = (down | (full & ~(x | up))) & full
            minus = up & x
            if score < best:
                best = score
                if not best:
                    break
        return best if best <= budget else None


class Matcher:
    """All pieces of some items (key, normal text) in one automaton."""

    def __init__(self, items: list[tuple[str, bytes]], error_rate: float):
        import ahocorasick

        self.items, self.budgets, self.patterns = items, [int(len(t) * error_rate) for _, t in items], {}
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text) in enumerate(items):
            for at, piece in pieces_of(text, self.budgets[k]):
                found.setdefault(piece.decode("latin-1"), []).append((k, at))
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: bytes) -> list[tuple[str, int]]:
        """(key, distance) of every item within its budget of some stretch of a normal text."""
        windows: dict[int, list[tuple[int, int]]] = {}
        if not len(self.automaton):
            return []
        for end, (size, where) in self.automaton.iter(text.decode("latin-1")):
            for k, at in where:
                start = end + 1 - size - at - self.budgets[k]
                windows.setdefault(k, []).append((max(0, start), start + len(self.items[k][1]) + 2 * self.budgets[k]))
        out = []
        for k, spans in windows.items():
            spans.sort()
            joined = [list(spans[0])]
            for a, z in spans[1:]:
                if a <= joined[-1][1]:
                    joined[-1][1] = max(z, joined[-1][1])
                else:
                    joined.append([a, z])
            if k not in self.patterns:
                self.patterns[k] = Pattern(self.items[k][1])
            found = [d for a, z in joined if (d := self._distance(k, text[a:z])) is not None]
            if found:
                out.append((self.items[k][0], min(found)))
        return out

    def _distance(self, k: int, text: bytes) -> int | None:
        return 0 if self.items[k][1] in text else self.patterns[k].distance(text, self.budgets[k])


def benchmark_items(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """item_id, text (normal), item (its key) of every different item."""
    lower = F.translate(F.col(text_column).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "))
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), text.alias("text")).where("text <> ''").distinct()
    return rows.withColumn("item", F.sha2("text", 256))


def item_parts(items: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Key and text of the different items, in parts of bounded size that are read one at a time."""
    once = items.select("item", "text").distinct()
    size = once.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // PART_BYTES)
    for k in range(parts):
        part = once.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k).orderBy("item").collect()
        if part:
            yield [(r.item, r.text.encode()) for r in part]


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.08, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, key, item_id, distance of every pair of a document and an item that it holds within error_rate edits a byte."""
    items = benchmark_items(benchmark, item_id, item_text)
    found = None
    for part in item_parts(items):
        more = _matches(docs, part, error_rate, id_column, text_column)
        found = more if found is None else found.unionByName(more)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, key long, item_id long, distance int")
    ids = items.select("item", "item_id")
    return found.join(F.broadcast(ids) if ids.count() <= FEW_ITEMS else ids, "item").select("doc_id", "key", "item_id", "distance")


def _matches(docs: DataFrame, part: list[tuple[str, bytes]], error_rate: float, id_column: str, text_column: str) -> DataFrame:
    """doc_id, key, item, distance of the items of one part."""
    items = docs.sparkSession.sparkContext.broadcast(part)

    def search(batches: Batches) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, error_rate)
        for b in batches:
            data, off = utf8(b.column("text"))
            low = LOWER[data]
            rows, keys, distances = [], [], []
            for row, (a, z) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                for i, d in matcher.matches(b" ".join(low[a:z].tobytes().split())):
                    rows.append(row)
                    keys.append(i)
                    distances.append(d)
            at = pa.array(rows, pa.int64())
            yield batch(doc_id=b.column("doc_id").take(at), key=b.column("key").take(at), item=pa.array(keys, pa.string()), distance=pa.array(distances, pa.int32()))

    return texts(docs, id_column, text_column).transform(mapped, search, "doc_id long, key long, item string, distance int")


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.08, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns.

    Items are looked for part by part: each part is one narrow pass that decides row by row about the rows that are left.
    """
    for part in item_parts(benchmark_items(benchmark, item_id, item_text)):
        docs = docs.transform(mapped, _keeps(docs, part, error_rate, text_column), docs.schema)
    return docs


def _keeps(docs: DataFrame, part: list[tuple[str, bytes]], error_rate: float, text_column: str):
    items = docs.sparkSession.sparkContext.broadcast(part)

    def keep(batches: Batches) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, error_rate)
        for b in batches:
            data, off = utf8(b.column(text_column))
            low = LOWER[data]
            clean = []
            for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                clean.append(not matcher.matches(b" ".join(low[a:z].tobytes().split())))
            yield b.filter(pa.array(clean, pa.bool_()))

    return keep
