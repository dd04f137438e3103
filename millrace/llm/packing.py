"""Best-fit packing: bounded-space online best fit of token pieces into sequences.

Documents are turned into token ids, followed by an end id; only those longer than a sequence are cut. Pieces arrive in a random
but fixed order in shards of bounded size. A shard keeps a fixed number of open sequences in a bitset keyed by free space: a piece
goes where it leaves the least space; if it fits nowhere and all places are taken, the fullest sequence closes first.

Words are encoded once and looked up, where the tokenizer's settings allow it (NORMALIZER, PIECES): such a tokenizer lowers letters
and never merges across white space or between letters and marks, so the ids of a text are those of its parts. Any other tokenizer
encodes the texts itself. Texts are encoded whole.
Words are told apart by 64-bit hashes.

Defined results: a null or empty text is one piece that holds the end id alone; a null doc_id stays null; rows that share a doc_id
are documents of their own; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Batches, batch, mapped, ragged, stored, utf8, word_hashes, word_spans

#: Settings of tokenizers that read word by word: fixed values of the format.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Words that a worker remembers, at some 30 bytes each; then it starts anew.
REMEMBERED = 500_000
#: Texts of words that are encoded at once: encodings take many times the room of their ids.
AT_ONCE = 8
#: Bytes after which a full stop or comma is a part of its own.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[ord("a") : ord("z") + 1] = True


def parts_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and end bytes of the parts of all rows, and the offsets of the rows in these; data is in lower case.

    A full stop or comma that ends a word after a letter is a part of its own for the tokenizer, too.
    """
    s, e, _ = word_spans(data, off)
    last = data[e - 1]
    mark = ((last == ord(".")) | (last == ord(","))) & (e - s > 1)
    mark[mark] = IS_LETTER[data[e[mark] - 2]]
    cut = np.repeat(e, 1 + mark)
    start = np.repeat(s, 1 + mark)
    second = np.flatnonzero(mark) + np.cumsum(mark)[mark]
    start[second] = cut[second] - 1
    cut[second - 1] -= 1
    return start, cut, np.searchsorted(start, off)


class WordIds:
    """Token ids of texts, by parts between ASCII white space. Parts that are new are learned many at once; their hashes tell them apart."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a part
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _encode(self, parts: list[str]) -> list[list[int]]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in encode(parts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        """Parts that are new, by their hashes (ascending) and their places in data."""
        size, raw = e - s, data.tobytes()
        bad = np.r_[0, np.cumsum(~IS_LETTER[data])]
        is_plain = bad[e] == bad[s]
        for k in np.flatnonzero(~is_plain).tolist():
            text = raw[s[k] : e[k]].decode()
            # letters that normalization leaves as they are make one run of tokens, of which the last ends a word
            is_plain[k] = text.isalpha() and max(text) < "\u0180"
        plain, other = np.flatnonzero(is_plain), [np.flatnonzero(~is_plain)]
        ids, lengths, known = [self.ids], [self.length], []
        groups = [plain[k : k + 500] for k in range(0, len(plain), 500)]
        for k in range(0, len(groups), AT_ONCE):
            joined = [b" ".join([raw[a:z] for a, z in zip(s[g].tolist(), e[g].tolist(), strict=True)]).decode() for g in groups[k : k + AT_ONCE]]
            for group, got in zip(groups[k : k + AT_ONCE], self._encode(joined), strict=True):
                got = np.array(got, np.uint32)
                last = np.flatnonzero(self.ends[got])
                if len(last) != len(group) or last[-1] != len(got) - 1:
                    other.append(group)
                    continue
                ids.append(got)
                lengths.append(np.diff(np.r_[-1, last]).astype(np.int32))
                known.append(group)
        other = np.concatenate(other)
        for k in range(0, len(other), 5000):
            few = other[k : k + 5000]
            got = self._encode([raw[a:z].decode() for a, z in zip(s[few].tolist(), e[few].tolist(), strict=True)])
            lengths.append(np.fromiter(map(len, got), np.int32, len(got)))
            ids.append(np.fromiter((i for x in got for i in x), np.uint32))
            known.append(few)
        at = np.empty(len(size), np.int32)
        at[np.concatenate(known)] = np.arange(len(self.length), len(self.length) + len(size))
        into = np.searchsorted(self.known, hashes)
        self.known, self.place = np.insert(self.known, into, hashes), np.insert(self.place, into, at)
        self.ids, self.length = np.concatenate(ids), np.concatenate(lengths)
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text. The tokenizer lowers letters itself; texts that may hold its special tokens go to it whole."""
        if len(self.known) > REMEMBERED:
            self._forget()
        whole = [b"<|" in t for t in texts]
        off = np.r_[0, np.cumsum([0 if w else len(t) for t, w in zip(texts, whole, strict=True)], dtype=np.int64)]
        data = LOWER[np.frombuffer(b"".join(t for t, w in zip(texts, whole, strict=True) if not w), np.uint8)]
        s, e, rows = parts_of(data, off)
        own, first, index = np.unique(word_hashes(data, s, e), return_index=True, return_inverse=True)
        into = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[into] != own) if len(self.known) else np.arange(len(own))
        if len(new):
            self._learn(own[new], data, s[first[new]], e[first[new]])
        at = self.place[np.searchsorted(self.known, own)][index]
        for text, is_whole, a, z in zip(texts, whole, rows[:-1].tolist(), rows[1:].tolist(), strict=True):
            if is_whole:
                yield np.array(self._encode([text.decode()])[0], np.uint32)
                continue
            yield self.ids[ragged(self.start[at[a:z]], self.length[at[a:z]])]


class TextIds:
    """Token ids of texts by any tokenizer, a few texts at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for k in range(0, len(texts), AT_ONCE):
            for e in self.tokenizer.encode_batch([t.decode() for t in texts[k : k + AT_ONCE]], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)


def by_word(path: str) -> bool:
    """Whether the tokenizer reads word by word, so that WordIds gives its ids."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    model = found.get("model") or {}
    plain = model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
    return plain and found.get("normalizer") == NORMALIZER and found.get("pre_tokenizer") == PIECES and all(t["content"].startswith("<|") for t in found.get("added_tokens") or [])


#: What this worker has learned, for its next tasks.
_LEARNED: dict[str, WordIds | TextIds] = {}


def word_ids(path: str) -> WordIds | TextIds:
    if path not in _LEARNED:
        _LEARNED[path] = (WordIds if by_word(path) else TextIds)(path)
    return _LEARNED[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (binary, little-endian unsigned 32-bit) of every piece."""
    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        learned = word_ids(tokenizer)
        for b in batches:
            data, off = utf8(b.column("text"))
            rows, number, start, blobs = [], [], [], []
            for row, ids in enumerate(learned.encode([data[a:z].tobytes() for a, z in zip(off[:-1], off[1:], strict=True)])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, a in enumerate(range(0, len(ids), size)):
                    rows.append(row)
                    number.append(k)
                    start.append(a)
                    blobs.append(ids[a : a + size].tobytes())
            yield batch(doc_id=b.column("doc_id").take(pa.array(rows, pa.int64())), piece=pa.array(number, pa.int32()), start=pa.array(start, pa.int64()), length=pa.array([len(x) // 4 for x in blobs], pa.int64()), ids_crc32=pa.array([zlib.crc32(x) for x in blobs], pa.int64()), ids=pa.array(blobs, pa.binary()))

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).transform(mapped, cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary", rows=300, size=1 << 20)


class OpenSequences:
    """At most `most` open sequences, in a bitset keyed by free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.made = 0, 0, 0
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]

    def _put(self, number: int, space: int) -> None:
        if space:
            self.by_space[space].append(number)
            self.bits |= 1 << space
            self.count += 1

    def _take(self, space: int) -> int:
        held = self.by_space[space]
        number = held.pop()
        if not held:
            self.bits &= ~(1 << space)
        self.count -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the place in it of the next piece."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, space = self.made, self.size
            self.made += 1
        self._put(number, space - length)
        return number, self.size - space


def best_fit(cut: DataFrame, size: int = 2048, open_sequences: int = 4096, shard_pieces: int = 400_000) -> DataFrame:
    """The rows of `cut` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    shards = max(1, -(-cut.count() // shard_pieces))
    order = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit("order"))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))).withColumn("turn", order)

    def pack(batches: Batches) -> Iterator[pa.RecordBatch]:
        shard, held = None, None
        for b in batches:
            ids, offsets = [], []
            for s, n in zip(b.column("shard").to_pylist(), b.column("length").to_pylist(), strict=True):
                if s != shard:
                    shard, held = s, OpenSequences(size, open_sequences)
                number, at = held.place(n)
                ids.append(shard << 40 | number)
                offsets.append(at)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())], [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = dealt.select("shard", "turn", *kept).repartition(shards, "shard").sortWithinPartitions("shard", "turn", "doc_id", "piece", "ids_crc32")
    return rows.transform(mapped, pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, tokenizer: str, size: int = 2048, open_sequences: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs. The ids themselves are in pieces()."""
    return best_fit(stored(pieces(docs, tokenizer, size).drop("ids")), size, open_sequences)
