"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Texts are read in lower case. Each word, without marks around it, enters by itself and by its characters: a learned vector of the word (if the training rows know it) and of its byte
5-grams, and the smoothed log-odds of both, which leave out the row at hand while training. Windows of WIDTH words that overlap by
half cover the whole text; a network reads each window in both directions, pools the states by attention and gives a logit. The
score of a text is that of its most toxic window, so a text may be of any length.

The network is fitted on a bounded sample: at most `sample` labelled rows of either class, and of these as many as have
`sample_bytes` of text in all (but one of either class at least), in the order of a hash of the id; rows of any length are taken, and
taken whole, all different ones of an id. Near copies within the sample are left out. Everything else reads all rows.

Defined results: a null or empty text, or one without words, gets the share of toxic rows among the labelled training rows; if
these have one class only (or there are none), so does every text. Labels that are null are not used; of several labels of one id
the greatest counts, for every row of that id; a null doc_id is never held out; rows are scored on their own, so repeated rows get the same score; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BYTE_VALUES, LOWER, U64, Batches, batch, mapped, mix, powers, ragged, stored, utf8, word_hashes, word_spans

WIDTH, STRIDE = 48, 24
GRAM, GRAM_BITS, VECTOR_BITS = 5, 18, 12
HIDDEN, VECTOR, ATTENTION = 8, 8, 8
FACTS = 3  # log-odds of the word, mean and greatest log-odds of its 5-grams
#: Words known to the network: in at least so many training rows, and at most so many.
KNOWN_ROWS, KNOWN_WORDS = 3, 50_000
#: Windows that are read at once; a text may have any number of them. While training, when all that was read is kept, fewer.
TOGETHER, KEPT_TOGETHER = 2048, 512


#: ASCII characters that are neither letters nor digits: a word counts without those around it.
IS_MARK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def bare_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes, end bytes and row offsets of the words in lower case, without marks around them; of marks alone as they are."""
    s, e, rows = word_spans(data, off)
    inner = np.r_[np.flatnonzero(~IS_MARK[data]), len(data)]
    a, z = np.searchsorted(inner, s), np.searchsorted(inner, e) - 1
    has = a <= z
    s, e = np.where(has, inner[a], s), np.where(has, inner[np.maximum(z, 0)] + 1, e)
    return word_hashes(LOWER[data], s, e), s, e, rows


class Words:
    """The different ones of some words (hashes, first and end bytes): their hashes and the buckets of their byte 5-grams."""

    def __init__(self, data: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray):
        self.hashes, first, self.index = np.unique(h, return_index=True, return_inverse=True)
        s, n = s[first], (e - s)[first]
        size = np.maximum(GRAM, n + 2)
        at = np.cumsum(size) - size
        padded = np.full(int(size.sum()), 2, np.uint8)
        padded[at] = 1
        padded[ragged(at + 1, n)] = LOWER[data[ragged(s, n)]]
        v = BYTE_VALUES[padded]
        total = np.zeros(max(0, len(v) - GRAM + 1), np.uint64)
        for j, p in enumerate(powers(BASE, GRAM)):
            total += v[j : len(total) + j] * p
        self.grams = (mix(total[ragged(at, size - GRAM + 1)]) >> U64(64 - GRAM_BITS)).astype(np.int64)
        self.first = np.r_[0, np.cumsum(size - GRAM + 1)]


def windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of every window; together they cover every row."""
    n = np.diff(rows)
    count = np.where(n > 0, np.maximum(0, -(-(n - WIDTH) // STRIDE)) + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return row, rows[:-1][row] + start, np.minimum(WIDTH, n[row] - start)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    return (np.log((np.maximum(toxic, 0) + 1) / (n_toxic + 2)) - np.log((np.maximum(clean, 0) + 1) / (n_clean + 2))).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Parameters by name, and passes over windows of word vectors of shape (steps, windows, inputs)."""

    def __init__(self, known: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        inputs = FACTS + 2 * VECTOR
        draw = lambda *shape, by=1.0: (rng.standard_normal(shape) * by).astype(np.float32)
        self.p = {"word": draw(known + 1, VECTOR, by=0.05), "gram": draw(1 << VECTOR_BITS, VECTOR, by=0.05)}
        for d in "fb":
            self.p |= {f"W{d}": draw(inputs, 3 * HIDDEN, by=inputs**-0.5), f"U{d}": draw(HIDDEN, 3 * HIDDEN, by=HIDDEN**-0.5), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": draw(2 * HIDDEN, ATTENTION, by=0.25), "a": np.zeros(ATTENTION, np.float32), "v": draw(ATTENTION), "o": draw(2 * HIDDEN, by=0.5), "b": np.zeros(1, np.float32)}

    def _read(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction; x holds the inputs' part of the gates."""
        H, U = HIDDEN, self.p[f"U{d}"]
        h, out = np.zeros((x.shape[1], H), np.float32), np.empty((*x.shape[:2], H), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            u = h @ U
            gates = sigmoid(x[t, :, : 2 * H] + u[:, : 2 * H])
            r, z = gates[:, :H], gates[:, H:] * mask[t] + (1 - mask[t])
            n = np.tanh(x[t, :, 2 * H :] + r * u[:, 2 * H :])
            if keep is not None:
                keep.append((t, h, r, z, gates[:, H:], n, u[:, 2 * H :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows. x: (steps, windows, 6 * HIDDEN), the projected inputs of both directions; mask: (steps, windows, 1)."""
        p, half = self.p, 3 * HIDDEN
        kept = ([], []) if keep is not None else (None, None)
        h = np.concatenate([self._read(x[:, :, :half], mask, "f", kept[0]), self._read(x[:, :, half:], mask, "b", kept[1])], axis=2)
        e = np.tanh(h @ p["A"] + p["a"])
        s = np.where(mask[:, :, 0] > 0, e @ p["v"], -1e9)
        w = np.exp(s - s.max(axis=0))
        w /= w.sum(axis=0)
        c = (w[:, :, None] * h).sum(axis=0)
        if keep is not None:
            keep |= {"h": h, "e": e, "w": w, "c": c, "kept": kept}
        return c @ p["o"] + p["b"][0]

    def backward(self, grad: np.ndarray, mask: np.ndarray, keep: dict) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters and of the projected inputs for the gradient of the logits."""
        p, g, H = self.p, {}, HIDDEN
        h, e, w, c = (keep[k] for k in ("h", "e", "w", "c"))
        g["o"], g["b"] = c.T @ grad, np.array([grad.sum()], np.float32)
        dc = grad[:, None] * p["o"]
        dw = (h * dc).sum(axis=2)
        ds = w * (dw - (w * dw).sum(axis=0))
        dh = w[:, :, None] * dc
        g["v"] = np.einsum("tna,tn->a", e, ds)
        de = (1 - e * e) * (ds[:, :, None] * p["v"])
        g["A"], g["a"] = np.einsum("tnh,tna->ha", h, de), de.sum(axis=(0, 1))
        dh = dh + de @ p["A"].T
        dx = np.zeros((*h.shape[:2], 6 * H), np.float32)
        for i, d in enumerate("fb"):
            U, back = p[f"U{d}"], np.zeros((h.shape[1], H), np.float32)
            g[f"U{d}"] = np.zeros_like(U)
            for t, before, r, z, raw, n, u in reversed(keep["kept"][i]):
                back = back + dh[t, :, i * H : (i + 1) * H]
                dn = back * (1 - z) * (1 - n * n)
                dz = back * (before - n) * mask[t] * raw * (1 - raw)
                dr = dn * u * r * (1 - r)
                du = np.concatenate([dr, dz, dn * r], axis=1)
                dx[t, :, i * 3 * H : (i + 1) * 3 * H] = np.concatenate([dr, dz, dn], axis=1)
                g[f"U{d}"] += before.T @ du
                back = back * z + du @ U.T
        return g, dx


class Model:
    """What scoring needs: the network, the words it knows and the log-odds; a few MB, whatever the corpus."""

    def __init__(self, prior: float):
        self.prior, self.network = prior, None

    def vectors(self, w: Words, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of each different word (facts, word vector, mean of the 5-gram vectors), and its place among known words."""
        place = np.searchsorted(self.known, w.hashes)
        place[place == len(self.known)] = 0
        place = np.where(self.known[place] == w.hashes, place + 1, 0) if len(self.known) else np.zeros(len(w.hashes), np.int64)
        p = self.network.p
        word = np.where(place[:, None] > 0, p["word"][place], 0)
        total = np.add.reduceat(p["gram"][w.grams & ((1 << VECTOR_BITS) - 1)], w.first[:-1], axis=0) if len(w.hashes) else np.zeros((0, VECTOR))
        return np.concatenate([facts, word, total / np.diff(w.first)[:, None]], axis=1).astype(np.float32), place

    def facts(self, w: Words, left_out: int | None = None) -> np.ndarray:
        """Log-odds of each different word, without one row of the class left_out if that is given."""
        minus = (left_out == 1, left_out == 0)
        place = np.searchsorted(self.seen, w.hashes)
        place[place == len(self.seen)] = 0
        known = self.seen[place] == w.hashes if len(self.seen) else np.zeros(len(w.hashes), bool)
        n = [np.where(known, x[place], 0) if len(x) else np.zeros(len(w.hashes)) for x in self.word_rows]
        own = log_odds(n[0] - minus[0], n[1] - minus[1], *self.sizes)
        grams = log_odds(self.gram_rows[0] - minus[0], self.gram_rows[1] - minus[1], *self.sizes)[w.grams]
        if not len(w.hashes):
            return np.zeros((0, FACTS), np.float32)
        return np.stack([own, np.add.reduceat(grams, w.first[:-1]) / np.diff(w.first), np.maximum.reduceat(grams, w.first[:-1])], axis=1)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The score of each row."""
        out = np.full(len(off) - 1, self.prior)
        if self.network is None or not len(out):
            return out
        h, s, e, rows = bare_words(data, off)
        row, first, n = windows(rows)
        if not len(row):
            return out
        p = self.network.p
        logit = np.empty(len(row), np.float32)
        for k in range(0, len(row), TOGETHER):
            f, c = first[k : k + TOGETHER], n[k : k + TOGETHER]
            a, z = int(f[0]), int((f + c).max())
            w = Words(data, h[a:z], s[a:z], e[a:z])
            x, _ = self.vectors(w, self.facts(w))
            x = x @ np.concatenate([p["Wf"], p["Wb"]], axis=1) + np.concatenate([p["cf"], p["cb"]])
            logit[k : k + TOGETHER] = self.network.forward(*gather(x, w.index, f - a, c))
        at = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[at]] = sigmoid(np.maximum.reduceat(logit, at).astype(np.float64))
        return out


def gather(x: np.ndarray, index: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (steps, windows, ...) and mask of windows of words."""
    steps = np.arange(int(n.max()))[:, None]
    at = np.minimum(first + steps, len(index) - 1)
    return x[index[at]], (steps < n).astype(np.float32)[:, :, None]


def different(texts: list[bytes]) -> np.ndarray:
    """The texts without those that share half of 8 least hashes of word pairs with an earlier one: copies would pass for evidence."""
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    h, _, _, rows = bare_words(np.frombuffer(b"".join(texts), np.uint8), off)
    kept, seen = [], [{} for _ in range(8)]
    for k in range(len(texts)):
        own = h[rows[k] : rows[k + 1]]
        pairs = own[:-1] * U64(3) + own[1:] if len(own) > 1 else own
        least = [int(mix(pairs ^ U64(j * 0x9E3779B97F4A7C15 % (1 << 64))).min()) for j in range(8)] if len(own) else []
        votes: dict[int, int] = {}
        for j, x in enumerate(least):
            if x in seen[j]:
                votes[seen[j][x]] = votes.get(seen[j][x], 0) + 1
        if max(votes.values(), default=0) < 4:
            kept.append(k)
            for j, x in enumerate(least):
                seen[j].setdefault(x, k)
    return np.array(kept, np.int64)


def _parts(chosen: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(0, len(chosen), KEPT_TOGETHER):
        yield chosen[k : k + KEPT_TOGETHER], label[k : k + KEPT_TOGETHER]


class Step:
    """Windows of one training step (first words, numbers of words and labels of their rows): their logits and the gradients."""

    def __init__(self, net: Network, w: Words, place: np.ndarray, facts: list[np.ndarray], stays: np.ndarray, first: np.ndarray, n: np.ndarray, label: np.ndarray):
        self.net, p = net, net.p
        used, where = np.unique(w.index[np.minimum(first + np.arange(WIDTH)[:, None], len(w.index) - 1)], return_inverse=True)
        where = where.reshape(WIDTH, len(first))
        mask = (np.arange(WIDTH)[:, None] < n).astype(np.float32)[:, :, None]
        size = np.diff(w.first)[used]
        bucket = w.grams[ragged(w.first[used], size)] & ((1 << VECTOR_BITS) - 1)
        mean_gram = np.add.reduceat(p["gram"][bucket], np.cumsum(size) - size, axis=0) / size[:, None]
        learned = np.concatenate([np.where(place[used][:, None] > 0, p["word"][place[used]], 0), mean_gram], axis=1).astype(np.float32)
        self.stays = stays[used][:, None]
        learned = learned * self.stays * 2
        self.fact = np.where(label[None, :, None] == 1, facts[1][used][where], facts[0][used][where])
        self.x = np.concatenate([self.fact, learned[where]], axis=2).astype(np.float32)
        self.W = np.concatenate([p["Wf"], p["Wb"]], axis=1)
        self.mask, self.where, self.size, self.bucket, self.place, self.keep = mask, where, size, bucket, place[used], None

    def forward(self, keep: bool) -> np.ndarray:
        p = self.net.p
        self.keep = {} if keep else None
        return self.net.forward(self.x @ self.W + np.concatenate([p["cf"], p["cb"]]), self.mask, self.keep)

    def told(self) -> np.ndarray:
        """Of each window what its most telling word says."""
        return np.where(self.mask[:, :, 0] > 0, self.fact[:, :, 0] + self.fact[:, :, 2], -99).max(axis=0)

    def backward(self, grad: np.ndarray) -> dict:
        p = self.net.p
        if self.keep is None:
            self.forward(True)
        g, dx = self.net.backward(grad, self.mask, self.keep)
        self.keep = None
        flat = dx.reshape(-1, dx.shape[2])
        gw = self.x.reshape(-1, self.x.shape[2]).T @ flat
        g |= {"Wf": gw[:, : 3 * HIDDEN], "Wb": gw[:, 3 * HIDDEN :], "cf": flat[:, : 3 * HIDDEN].sum(0), "cb": flat[:, 3 * HIDDEN :].sum(0)}
        back = flat @ self.W[FACTS:].T
        n = len(self.place)
        each = np.stack([np.bincount(self.where.ravel(), back[:, j], n) for j in range(2 * VECTOR)], axis=1).astype(np.float32) * self.stays * 2
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], self.place, each[:, :VECTOR] * (self.place > 0)[:, None])
        g["gram"] = np.stack([np.bincount(self.bucket, np.repeat(each[:, VECTOR + j] / self.size, self.size), 1 << VECTOR_BITS) for j in range(VECTOR)], axis=1).astype(np.float32)
        return g


def fit(texts: list[bytes], toxic: np.ndarray, prior: float, steps: int = 200, rows_a_step: int = 48, seed: int = 7) -> Model:
    """A model of the training rows, after about as many steps; both classes weigh the same. Texts are in lower case."""
    model = Model(prior)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return model
    once = different(texts)
    texts, toxic = [texts[k] for k in once], toxic[once]
    if not (toxic == 1).any() or not (toxic == 0).any():
        return model
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    data = np.frombuffer(b"".join(texts), np.uint8)
    h, s, e, rows_at = bare_words(data, off)
    w = Words(data, h, s, e)
    doc = np.repeat(np.arange(len(texts)), np.diff(rows_at))
    pair = np.unique(doc * len(w.hashes) + w.index)
    d, k = pair // max(1, len(w.hashes)), pair % max(1, len(w.hashes))
    per = np.diff(w.first)[k]
    gram = np.unique(np.repeat(d, per) << GRAM_BITS | w.grams[ragged(w.first[k], per)])
    model.seen, model.sizes = w.hashes, (int((toxic == 1).sum()), int((toxic == 0).sum()))
    model.word_rows = [np.bincount(k[toxic[d] == c], minlength=len(w.hashes)).astype(np.int32) for c in (1, 0)]
    model.gram_rows = [np.bincount((gram & ((1 << GRAM_BITS) - 1))[toxic[gram >> GRAM_BITS] == c], minlength=1 << GRAM_BITS).astype(np.int32) for c in (1, 0)]
    rows = model.word_rows[0] + model.word_rows[1]
    often = np.flatnonzero(rows >= KNOWN_ROWS)
    often = np.sort(often[np.argsort(-rows[often], kind="stable")][:KNOWN_WORDS])
    model.known = w.hashes[often]
    net = model.network = Network(len(model.known), seed)
    row, first, n = windows(rows_at)
    facts = [model.facts(w, c) for c in (0, 1)]
    _, place = model.vectors(w, facts[0])
    rng, done, mean, square = np.random.default_rng(seed), 0, {}, {}
    weight = len(toxic) / 2 / np.maximum(1, np.bincount(toxic, minlength=2))
    at = np.searchsorted(row, np.arange(len(texts) + 1))
    has = np.flatnonzero(np.diff(at) > 0)
    while done < steps:
        order = rng.permutation(has)
        for s in range(0, len(order), rows_a_step):
            docs = order[s : s + rows_a_step]
            own = np.repeat(np.arange(len(docs)), at[docs + 1] - at[docs])
            chosen = ragged(at[docs], at[docs + 1] - at[docs])
            label = toxic[docs][own]
            stays = (rng.random(len(w.hashes)) < 0.5).astype(np.float32)  # of half the words only the log-odds are seen
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            one = len(chosen) <= KEPT_TOGETHER
            step = lambda c, y: Step(net, w, place, facts, stays, first[c], n[c], y)  # noqa: B023, E731
            parts, logit, told = [], [], []
            for c, y in _parts(chosen, label):
                x = step(c, y)
                logit.append(x.forward(keep=one))
                told.append(x.told())
                if one:
                    parts = [x]
            logit, told = np.concatenate(logit), np.concatenate(told)
            top = np.maximum.reduceat(logit, start)
            # the window that decides; at first, in toxic rows, the one with the most telling word
            rank = np.where((label == 1) & (2 * done < steps), told, logit)
            best = np.zeros(len(logit), bool)
            best[[i + int(np.argmax(rank[i:j])) for i, j in zip(start, np.r_[start[1:], len(logit)], strict=True)]] = True
            # of a clean row every window learns a little
            grad = np.where(best, np.where(label == 1, sigmoid(logit) - 1, sigmoid(top)[own]), np.where(label == 0, 0.2 * sigmoid(logit), 0)) * weight[label] / len(docs)
            grad = grad.astype(np.float32)
            if not one:  # once more, for the windows that learn
                chosen, label, grad = chosen[grad != 0], label[grad != 0], grad[grad != 0]
                parts = (step(c, y) for c, y in _parts(chosen, label))
            g = {}
            for k, x in enumerate(parts):
                for name, v in x.backward(grad[k * KEPT_TOGETHER : (k + 1) * KEPT_TOGETHER]).items():
                    g[name] = g[name] + v if name in g else v
            done, p = done + 1, net.p
            rate = 0.02 * min(1.0, max(0.05, 2 - 2 * done / steps))  # falls from half way on, so that the last rows seen don't decide
            scale = min(1.0, 1.0 / (1e-6 + np.sqrt(sum(float((v * v).sum()) for v in g.values()))))
            for name, v in g.items():  # Adam
                v = v * scale + (0.003 * p[name] if name in ("word", "gram") else 0)
                mean[name] = 0.9 * mean.get(name, 0) + 0.1 * v
                square[name] = 0.99 * square.get(name, 0) + 0.01 * v * v
                p[name] = (p[name] - rate * (mean[name] / (1 - 0.9**done)) / (np.sqrt(square[name] / (1 - 0.99**done)) + 1e-6)).astype(np.float32)
    often = np.flatnonzero(rows > 1)  # what was in one row says little
    model.seen, model.word_rows = w.hashes[often], [x[often] for x in model.word_rows]
    return model


def held_out(doc_id, folds: int = 5):
    """Whether a row is kept from training: crc32 of its id as text is a multiple of folds."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, sample_bytes: int, id_column: str, text_column: str, label_id: str, label: str) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of the sample, and the share of toxic rows among all labelled training rows."""
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    total, toxic = known.agg(F.count("y"), F.sum("y")).first()
    if not toxic or toxic == total:
        return [], np.zeros(0, np.int64), float((toxic or 0) / total) if total else 0.0
    order = F.xxhash64("doc_id")
    picked = known.where("y = 1").orderBy(order, "doc_id").limit(sample).unionByName(known.where("y = 0").orderBy(order, "doc_id").limit(sample))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    # all different texts of the picked ids; an id may have any number of rows, so that these are bounded once more
    drawn = rows.join(F.broadcast(picked), "doc_id").distinct().withColumn("key", F.xxhash64("text"))
    drawn = stored(drawn.where("y = 1").orderBy(order, "doc_id", "key", "text").limit(sample).unionByName(drawn.where("y = 0").orderBy(order, "doc_id", "key", "text").limit(sample)))
    sizes = drawn.select("doc_id", "key", "y", F.octet_length("text").alias("n")).orderBy(order, "doc_id", "key").collect()
    taken, held = [], {0: 0, 1: 0}
    for r in sizes:
        if not held[r.y] or held[r.y] + r.n <= sample_bytes // 2:
            taken.append((r.doc_id, r.key))
        held[r.y] += r.n + 1
    chosen = docs.sparkSession.createDataFrame(taken, "doc_id long, key long")
    got = drawn.join(F.broadcast(chosen), ["doc_id", "key"], "left_semi").orderBy("doc_id", "key").collect()
    return [r.text.lower().encode() for r in got], np.array([r.y for r in got], np.int64), toxic / total


def train(docs: DataFrame, labels: DataFrame, sample: int = 1000, sample_bytes: int = 16 << 20, id_column: str = "doc_id", text_column: str = "text", label_id: str = "doc_id", label: str = "toxic") -> Model:
    texts, y, prior = training_rows(docs, labels, sample, sample_bytes, id_column, text_column, label_id, label)
    try:
        return fit(texts, y, prior)
    finally:  # the driver gives back what training needed
        del texts, y
        ctypes.CDLL(None).malloc_trim(0)


def _scored(docs: DataFrame, model: Model, text_column: str, finish, schema) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield finish(b, sent.value.score(*utf8(pc.utf8_lower(b.column(text_column)))))

    return docs.transform(mapped, score, schema, rows=500, size=1 << 20)


def toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(F.col(id_column)).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    finish = lambda b, s: batch(doc_id=b.column("doc_id"), held_out=b.column("held_out"), score=s, predicted=(s >= 0.5).astype(np.int32))
    return _scored(picked, model, "text", finish, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs with scores below the threshold, with all their columns."""
    return _scored(docs, model, text_column, lambda b, s: b.filter(pa.array(s < threshold)), docs.schema)
