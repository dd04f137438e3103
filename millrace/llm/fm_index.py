"""A compressed FM-index: the Burrows-Wheeler transform of a text in a wavelet matrix of packed bits, searched backwards.

Beside the wavelet matrix it keeps one byte a symbol (the length that neighbouring suffixes share, up to the depth of the searches), the
starts of the blocks of suffixes that share a whole search or all of it but one symbol, and one value for each of the former. The suffix
array is gone once these are made. All searches run side by side: a step of every search is one set of numpy operations.
"""

from __future__ import annotations

import numpy as np

from .common import U64


class Bits:
    """Packed bits with the number of ones before each word: 1.5 bits a bit."""

    def __init__(self, bits: np.ndarray):
        raw = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(raw)] = raw
        self.words = words
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        part = self.words[w] & ((U64(1) << (i & 63).astype(np.uint64)) - U64(1))
        return self.before[w] + np.bitwise_count(part)


class Wavelet:
    """rank(c, i): how often each symbol occurs among the first i of a text."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        for k in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            bit = (text >> k & 1).astype(bool)
            self.levels.append((k, Bits(bit)))
            self.zeros.append(int(len(bit) - bit.sum()))
            text = np.r_[text[~bit], text[bit]]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        start = np.zeros(len(c), np.int64)
        for (k, bits), zeros in zip(self.levels, self.zeros, strict=True):
            one = (c >> k & 1).astype(bool)
            a, b = bits.ones(start), bits.ones(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes sorted by their first symbols, depth of them at least, and the ranks by 1, 2, 4, ... symbols."""
    n = len(text)
    ranks = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while True:
        r = ranks[-1]
        if step >= depth or (len(r) and int(r.max()) == n - 1):
            return np.argsort(r, kind="stable"), ranks
        then = np.zeros(n, np.int64)
        then[: max(0, n - step)] = r[step:] + 1
        ranks.append(np.unique(r * (n + 1) + then, return_inverse=True)[1].astype(np.int64))
        step *= 2


def common_prefixes(sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """lcp[k]: symbols that the suffixes k-1 and k share, as far as they were sorted; 0 at both ends."""
    n = len(sa)
    a, b = sa[:-1].copy(), sa[1:].copy()
    out = np.zeros(n + 1, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = (a < n) & (b < n)
        same[same] = ranks[k][a[same]] == ranks[k][b[same]]
        out[1:n][same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return out


#: Lengths whose least is kept, to jump over them.
BLOCK = 64


class FMIndex:
    """Of a text of integers above 0; searches are exact for up to depth symbols (254 at most). values: one for each place of the text,
    of which least_of gives the least of the places where a search of depth symbols ends."""

    def __init__(self, text: np.ndarray, depth: int, values: np.ndarray | None = None):
        if not 0 < depth < 255:
            raise ValueError("depth must be 1 to 254")
        text = np.r_[text, 0]
        self.depth, self.symbols, self.size = depth, int(text.max()) + 1, len(text)
        sa, ranks = sorted_suffixes(text, depth + 1)
        self.lcp = np.minimum(common_prefixes(sa, ranks), depth).astype(np.uint8)
        del ranks
        self.wavelet = Wavelet(text[sa - 1], self.symbols)
        self.less = np.r_[0, np.cumsum(np.bincount(text, minlength=self.symbols))]
        self.nearly = np.flatnonzero(self.lcp[:-1] < depth - 1).astype(np.int32)  # blocks of suffixes that share depth - 1 symbols
        self.whole = np.flatnonzero(self.lcp[:-1] < depth).astype(np.int32)
        self.least = None if values is None else np.minimum.reduceat(np.r_[values, np.iinfo(np.int64).max][sa], self.whole)
        padded = np.r_[self.lcp, np.zeros(-len(self.lcp) % BLOCK, np.uint8)]
        self.lows = padded.reshape(-1, BLOCK).min(axis=1)

    def least_of(self, low: np.ndarray) -> np.ndarray:
        """The least value of each interval of a search of depth symbols, which begins at low."""
        return self.least[np.searchsorted(self.whole, low, "right") - 1]

    def _less_before(self, k: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The last place before k where neighbours share less than v > 0 symbols; there is one, as the first shares none."""
        k = k - 1
        todo = np.flatnonzero(self.lcp[k] >= v)
        while len(todo):
            at = k[todo]
            whole = (at % BLOCK == BLOCK - 1) & (self.lows[at // BLOCK] >= v[todo])
            k[todo] = at = at - np.where(whole, BLOCK, 1)
            todo = todo[self.lcp[at] >= v[todo]]
        return k

    def _less_after(self, k: np.ndarray, v: np.ndarray) -> np.ndarray:
        k = k + 1
        todo = np.flatnonzero(self.lcp[k] >= v)
        while len(todo):
            at = k[todo]
            whole = (at % BLOCK == 0) & (self.lows[at // BLOCK] >= v[todo])
            k[todo] = at = at + np.where(whole, BLOCK, 1)
            todo = todo[self.lcp[at] >= v[todo]]
        return k

    def matching_statistics(self, stream: np.ndarray, bounds: np.ndarray):
        """Of each place of the streamed documents: how many symbols from there occur in the text (up to depth), and the interval.

        Documents are read backwards, all in step. A symbol that doesn't extend the match shortens it to its parent interval.
        """
        n = len(stream)
        length, low, high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size, np.int64)
        live = np.flatnonzero(np.diff(bounds) > 0)
        at, first = bounds[1:][live] - 1, bounds[:-1][live]
        lo, hi, size = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64), np.zeros(len(live), np.int64)
        ends = np.r_[self.nearly[1:], self.size]
        while len(at):
            full = np.flatnonzero(size >= self.depth)
            block = np.searchsorted(self.nearly, lo[full], "right") - 1
            lo[full], hi[full], size[full] = self.nearly[block], ends[block], self.depth - 1
            c = stream[at]
            known = (c > 0) & (c < self.symbols)
            both = self.wavelet.rank(np.tile(np.where(known, c, 0), 2), np.r_[lo, hi]) + np.tile(self.less[np.where(known, c, 0)], 2)
            a, b = both[: len(at)], both[len(at) :]
            fits = known & (a < b)
            empty = ~fits & (size == 0)
            lo, hi, size = np.where(fits, a, lo), np.where(fits, b, hi), size + fits
            done = fits | empty
            length[at[done]], low[at[done]], high[at[done]] = size[done], lo[done], hi[done]
            up = np.flatnonzero(~done)
            if len(up):
                k = np.where(self.lcp[lo[up]] >= self.lcp[hi[up]], lo[up], hi[up])
                v = self.lcp[k]
                size[up] = v
                some = v > 0
                lo[up], hi[up] = 0, self.size
                lo[up[some]], hi[up[some]] = self._less_before(k[some], v[some]), self._less_after(k[some], v[some])
            at = at - done
            keep = at >= first
            at, first, lo, hi, size = at[keep], first[keep], lo[keep], hi[keep], size[keep]
        return length, low, high
