"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word begins with the longest piece of the vocabulary that starts words, and goes on with the longest pieces
that continue words. The automaton is a trie of the pieces with failure links: where no edge goes on, the link leads to the place
that is reached once the longest pieces so far have been popped, and the number of pieces popped on the way is stored with it. So
a word's count comes from one walk over its bytes, and no piece is ever built. A word that cannot be split counts as one unknown
token.

Different words of a batch are walked side by side with numpy; texts are counted whole.

Defined results: a null or empty text has no tokens; rows are counted on their own, so repeated rows get the same counts; a null
doc_id stays null; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, batch, mapped, utf8, words

NONE = -1
#: Words up to this many bytes are walked side by side, longer ones one by one.
LONG = 64


class LongestMatch:
    """The automaton for pieces that start words and pieces that continue them, both as bytes."""

    def __init__(self, starting: set[bytes], continuing: set[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]  # node 0 starts a word, node 1 continues it
        ends: list[bool] = [False, False]
        order = [0, 1]
        for root, pieces in ((0, starting), (1, continuing)):
            for piece in sorted(pieces):
                node = root
                for c in piece:
                    if c not in self.edges[node]:
                        self.edges[node][c] = len(self.edges)
                        self.edges.append({})
                        ends.append(False)
                    node = self.edges[node][c]
                ends[node] = ends[node] or node > 1
        n = len(self.edges)
        self.link, self.popped = [NONE] * n, [0] * n
        for node in order:  # breadth first, so that links of parents are known
            for c, child in self.edges[node].items():
                if ends[child]:
                    self.link[child], self.popped[child] = 1, 1
                else:
                    at, k = self.link[node], self.popped[node]
                    while at != NONE and c not in self.edges[at]:
                        k += self.popped[at]
                        at = self.link[at]
                    if at != NONE:
                        self.link[child], self.popped[child] = self.edges[at][c], k
                order.append(child)
        used = sorted({c for e in self.edges for c in e})
        self.symbol = np.zeros(256, np.int64)
        self.symbol[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        self.width = width
        keys = np.array(sorted((node * width + int(self.symbol[c]), child) for node, e in enumerate(self.edges) for c, child in e.items()), np.int64).reshape(-1, 2)
        # edges in an open table: twice a power of two as many places as edges
        self.mask = (1 << max(4, (2 * len(keys)).bit_length() + 1)) - 1
        self.keys, self.next = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        todo, place = np.arange(len(keys)), self._place(keys[:, 0])
        while len(todo):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[todo[free], 0]
            put = self.keys[place] == keys[todo, 0]
            self.next[place[put]] = keys[todo[put], 1]
            todo, place = todo[~put], (place[~put] + 1) & self.mask
        self.links, self.pops = np.array(self.link, np.int32), np.array(self.popped, np.int32)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key * 0x9E3779B1 >> 7) & self.mask

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = node * np.int64(self.width) + symbol
        place = self._place(key)
        out = np.where(symbol > 0, self.next[place], NONE)
        held = self.keys[place]
        todo = np.flatnonzero((held != key) & (symbol > 0))
        out[todo] = NONE
        todo = todo[held[todo] >= 0]
        while len(todo):
            place[todo] = (place[todo] + 1) & self.mask
            held = self.keys[place[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.next[place[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]; 1 for a word that cannot be split."""
        out = np.zeros(len(start), np.int64)
        for k in np.flatnonzero(end - start > LONG):
            out[k] = self.count_one(data[start[k] : end[k]].tobytes())
        short = np.flatnonzero(end - start <= LONG)
        short = short[np.argsort((end - start)[short], kind="stable")]
        at, stop = start[short].copy(), end[short]
        node, live = np.zeros(len(short), np.int64), np.arange(len(short))
        total = np.zeros(len(short), np.int64)
        while len(live):
            more = at[live] < stop[live]
            # at the end only links are followed, until node 1 is reached
            symbol = np.where(more, self.symbol[data[np.minimum(at[live], len(data) - 1)]], 0)
            to = self._step(node[live], symbol)
            goes = more & (to != NONE)
            node[live[goes]] = to[goes]
            at[live[goes]] += 1
            back = live[~goes]
            total[back] += self.pops[node[back]]
            node[back] = self.links[node[back]]
            done = (at[live] >= stop[live]) & (node[live] == 1) | (node[live] == NONE)
            live = live[~done]
        out[short] = np.where(node == NONE, 1, total)
        return out

    def count_one(self, word: bytes) -> int:
        node, total = 0, 0
        for c in word:
            while node != NONE and c not in self.edges[node]:
                total += self.popped[node]
                node = self.link[node]
            if node == NONE:
                return 1
            node = self.edges[node][c]
        while node not in (1, NONE):
            total += self.popped[node]
            node = self.link[node]
        return total if node == 1 else 1


def piece_vocabulary(path: str, mark: str = "▁") -> tuple[set[bytes], set[bytes]]:
    """Pieces that start words and pieces that continue them, from a model file whose word starts carry the mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starting, continuing = set(), set()
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or mark in piece[1:]:
            continue
        if piece.startswith(mark):
            if len(piece) > 1:
                starting.add(piece[1:].encode())
        else:
            continuing.add(piece.encode())
    return starting, continuing


#: The automata of this worker, by what they were made for: a worker runs many tasks.
_HELD: dict[int, LongestMatch] = {}


def _automaton(name: int, vocabulary: Broadcast) -> LongestMatch:
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = LongestMatch(*vocabulary.value)
    return _HELD[name]


def token_counts(docs: DataFrame, starting: set[bytes], continuing: set[bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens of every row of docs. The vocabulary has a fixed size and is sent to every task."""
    sent = docs.sparkSession.sparkContext.broadcast((starting, continuing))
    name = uuid.uuid4().int

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, sent)
        for b in batches:
            data, off = utf8(b.column("text"))
            h, s, e, rows = words(data, off)
            _, first, index = np.unique(h, return_index=True, return_inverse=True)
            each = automaton.count(data, s[first], e[first])[index]
            total = np.r_[0, np.cumsum(each)]
            yield batch(doc_id=b.column("doc_id"), n_bytes=np.diff(off), n_words=np.diff(rows).astype(np.int64), n_tokens=total[rows[1:]] - total[rows[:-1]])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).transform(mapped, count, "doc_id long, n_bytes long, n_words long, n_tokens long")
