"""The draws of a Mersenne Twister seeded by a whole number, for many seeds at once (SF8, SF22): what the standard generator gives."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the generator: size of its state, the place that is mixed in, and the multipliers of its seeding and its twist.
SIZE, MIDDLE = 624, 397
FIRST_SEED, GROW, BY_KEY, AFTER = 19650218, 1812433253, 1664525, 1566083941
TWIST, UPPER, LOWER = 0x9908B0DF, 0x80000000, 0x7FFFFFFF
#: Seeds that are worked on together: SIZE words of eight bytes each.
TOGETHER = 4096

U32 = np.uint64(0xFFFFFFFF)


class Twisters:
    """One generator for each seed (below 2**32); outputs come in order, for some of the generators at a time."""

    def __init__(self, seeds: np.ndarray):
        base = np.empty(SIZE, np.uint64)
        base[0] = FIRST_SEED
        for i in range(1, SIZE):
            base[i] = (GROW * (int(base[i - 1]) ^ int(base[i - 1]) >> 30) + i) & 0xFFFFFFFF
        s = np.repeat(base[:, None], len(seeds), axis=1)
        key, i = seeds.astype(np.uint64), 1
        for _ in range(SIZE):
            s[i] = ((s[i] ^ (s[i - 1] ^ s[i - 1] >> np.uint64(30)) * np.uint64(BY_KEY)) + key) & U32
            i += 1
            if i == SIZE:
                s[0], i = s[SIZE - 1], 1
        for _ in range(SIZE - 1):
            s[i] = ((s[i] ^ (s[i - 1] ^ s[i - 1] >> np.uint64(30)) * np.uint64(AFTER)) - np.uint64(i)) & U32
            i += 1
            if i == SIZE:
                s[0], i = s[SIZE - 1], 1
        s[0] = UPPER
        self.state, self.at = s, np.zeros(len(seeds), np.int64)

    def _twist(self, i: int, who: np.ndarray) -> None:
        s = self.state
        y = s[i, who] & np.uint64(UPPER) | s[(i + 1) % SIZE, who] & np.uint64(LOWER)
        s[i, who] = s[(i + MIDDLE) % SIZE, who] ^ y >> np.uint64(1) ^ (y & np.uint64(1)) * np.uint64(TWIST)

    def words(self, who: np.ndarray) -> np.ndarray:
        """The next 32 bits of some generators. A word of the state is made when it is due: the ones that it needs are not yet made anew."""
        out = np.empty(len(who), np.uint64)
        for i in np.unique(self.at[who] % SIZE):
            here = np.flatnonzero(self.at[who] % SIZE == i)
            self._twist(int(i), who[here])
            out[here] = self.state[i, who[here]]
        self.at[who] += 1
        out ^= out >> np.uint64(11)
        out ^= out << np.uint64(7) & np.uint64(0x9D2C5680)
        out ^= out << np.uint64(15) & np.uint64(0xEFC60000)
        return (out ^ out >> np.uint64(18)) & U32

    def below(self, n: int) -> np.ndarray:
        """A whole number below n for each generator: as many bits as n has, until they are below it."""
        shift, out = np.uint64(32 - n.bit_length()), np.empty(len(self.at), np.int64)
        who = np.arange(len(self.at))
        while len(who):
            got = (self.words(who) >> shift).astype(np.int64)
            out[who] = got
            who = who[got >= n]
        return out

    def random(self) -> np.ndarray:
        """A double within 0 and 1 (of 53 bits) for each generator."""
        who = np.arange(len(self.at))
        a, b = self.words(who) >> np.uint64(5), self.words(who) >> np.uint64(6)
        return (a * np.uint64(1 << 26) + b).astype(np.float64) / float(1 << 53)


def _each(seeds: pd.Series, draw) -> list[pd.DataFrame]:
    """draw of the generators of some seeds, together; a null seed gives nulls."""
    found = []
    values = seeds.dropna().astype("int64")
    for k in range(0, len(values), TOGETHER):
        part = values.iloc[k : k + TOGETHER]
        found.append(pd.DataFrame(draw(Twisters(part.to_numpy() & 0xFFFFFFFF)), index=part.index))
    return found


def dynamic_seed(salt: str, *key: Column) -> Column:
    """SF8: the last 32 bits of the hash of salt and key."""
    text = F.concat(F.lit(salt), *(x for k in key for x in (F.lit("|"), F.coalesce(k.cast("string"), F.lit("")))))
    return F.conv(F.substring(F.sha2(text, 256), 57, 8), 16, 10).cast("long")


def dynamic_choices(options: dict[str, list | str], salt: str, index: Column, seed: Column, sample_id: Column, image_path: Column) -> dict[str, Column]:
    """SF8: for each name its text, or one of its options: those that a generator seeded by the hash of the key picks, one after the other."""
    lists = {k: v for k, v in options.items() if isinstance(v, list)}
    if any(not v for v in lists.values()):
        raise ValueError("a list of options cannot be empty")
    sizes = [len(v) for v in lists.values()]

    @F.pandas_udf("array<int>")
    def pick(seeds: pd.Series) -> pd.Series:
        found = _each(seeds, lambda t: {j: t.below(n) for j, n in enumerate(sizes)})
        rows = pd.concat(found).astype("int32").apply(list, axis=1) if found else pd.Series(dtype=object)
        return rows.reindex(seeds.index)

    picked = pick(dynamic_seed(salt, index, seed, sample_id, image_path)) if lists else None
    place = {k: j for j, k in enumerate(lists)}
    return {k: F.get(F.array(*(F.lit(str(x)) for x in v)), F.get(picked, F.lit(place[k]))) if k in place else F.lit(str(v)) for k, v in options.items()}


def augmentations(seed: Column) -> Column:
    """SF22: struct of flip, degrees (within 8) and brightness (0.85 to 1.25), as a generator of this seed draws them. Seeds: 0 to 2**32 - 1."""

    @F.pandas_udf("flip boolean, degrees double, brightness double")
    def draw(seeds: pd.Series) -> pd.DataFrame:
        found = _each(seeds, lambda t: {"flip": t.random() > 0.5, "degrees": -8.0 + 16.0 * t.random(), "brightness": 0.85 + t.random() * 0.4})
        return (pd.concat(found) if found else pd.DataFrame({"flip": [], "degrees": [], "brightness": []})).reindex(seeds.index)

    return draw(seed)
