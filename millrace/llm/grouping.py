"""Suffix arrays by linear grouping.

Phase 1 sorts all suffixes into groups by their Lyndon prefix (the longest prefix that is a Lyndon word). Groups are taken from
the greatest to the least; when a group is taken, its word is final, and every member points to the nearest earlier suffix of a
lesser group. That suffix's word grows by the group's word, so it moves to the upper end of its own group, as a new group.
A pointer also jumps over everything greater, so that each suffix is passed over once.

Phase 2 walks the suffix array from its least suffix and, for each suffix found, puts the chain of pointers that starts just
before it into the next free places of their groups. Nothing is renamed and no smaller problem is solved.

`suffix_array` does this for one text. `suffix_arrays` does it for many short texts in step: each step takes the next group of
every text at once, with numpy.
"""

from __future__ import annotations

import numpy as np

from .common import ragged

#: Texts up to this length are done side by side; longer ones one by one.
SHORT = 8192
#: Symbols that are done side by side at once.
TOGETHER = 1 << 22


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of one text of small non-negative integers, of which the last must be the least (it may occur before, too).

    A suffix that ends is less than one that goes on.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    order = np.argsort(text, kind="stable")
    new = np.r_[True, text[order][1:] != text[order][:-1]]
    first = np.flatnonzero(new)
    size_at = np.zeros(n, np.int64)
    size_at[first] = np.diff(np.r_[first, n])
    group_of = np.empty(n, np.int64)
    group_of[order] = first[np.cumsum(new) - 1]
    place_of = np.empty(n, np.int64)
    place_of[order] = np.arange(n)
    sa, group, place, size = order.tolist(), group_of.tolist(), place_of.tolist(), size_at.tolist()
    before = [-1] * n
    top = n
    while top:
        low = group[sa[top - 1]]
        # members of the group, the suffix that each leads back to, and how many members in a row lead to it
        repeats: dict[int, int] = {}
        if top - low == 1:
            s = sa[low]
            p = s - 1
            while p >= 0 and group[p] >= top:
                p = before[p]
            before[s] = p
            if p >= 0:
                repeats[p] = 1
        else:
            runs: dict[int, int] = {}
            for s in sorted(sa[low:top]):
                p = s - 1
                while p >= 0 and group[p] >= top:
                    p = before[p]
                k = 1
                if p >= 0 and group[p] == low:
                    k = runs[p] + 1
                    p = before[p]
                runs[s] = k
                before[s] = p
                if p >= 0:
                    repeats[p] = k
        rounds = {1: list(repeats)} if len(repeats) < 2 or max(repeats.values()) == 1 else {}
        if not rounds:
            for p, k in repeats.items():
                rounds.setdefault(k, []).append(p)
        for k in sorted(rounds, reverse=True):
            taken: dict[int, int] = {}
            moved = rounds[k]
            for p in moved:
                g = group[p]
                t = taken.get(g, 0) + 1
                taken[g] = t
                last = g + size[g] - t
                at = place[p]
                if at != last:
                    q = sa[last]
                    sa[at], sa[last] = q, p
                    place[q], place[p] = at, last
            for g, t in taken.items():
                left = size[g] - t
                size[g] = left
                size[g + left] = t
                taken[g] = g + left
            for p in moved:
                group[p] = taken[group[p]]
        top = low
    return np.array(_emit(group, before, n))


def _emit(group: list[int], before: list[int], n: int) -> list[int]:
    sa, free, placed = [0] * n, list(range(n)), [False] * n
    sa[0] = n - 1
    placed[n - 1] = True
    free[group[n - 1]] += 1
    for i in range(n):
        s = sa[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            sa[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = before[s]
    return sa


def suffix_arrays(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix arrays of the texts between bounds, one after the other, as places in the whole array."""
    lengths = np.diff(bounds)
    out = np.empty(len(text), np.int64)
    for k in np.flatnonzero(lengths > SHORT):
        a, z = bounds[k], bounds[k + 1]
        out[a:z] = suffix_array(text[a:z]) + a
    short = np.flatnonzero((lengths > 0) & (lengths <= SHORT))
    short = short[np.argsort(lengths[short], kind="stable")]
    total = np.cumsum(lengths[short])
    for part in np.split(short, np.searchsorted(total, np.arange(TOGETHER, total[-1] if len(total) else 0, TOGETHER))):
        if len(part):
            source = ragged(bounds[part], lengths[part])
            own = np.r_[0, np.cumsum(lengths[part])]
            sa = _in_step(text[source], own)
            out[ragged(bounds[part], lengths[part])] = source[sa]
    return out


def _in_step(text: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n, start = len(text), bounds[:-1].astype(np.int32)
    owner = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(bounds))
    order = np.argsort((owner.astype(np.int64) << 20) | text, kind="stable").astype(np.int32)
    key = (owner.astype(np.int64) << 20 | text)[order]
    new = np.r_[True, key[1:] != key[:-1]]
    first = np.flatnonzero(new).astype(np.int32)
    size = np.zeros(n, np.int32)
    size[first] = np.diff(np.r_[first, n])
    group, place, sa = np.empty(n, np.int32), np.empty(n, np.int32), order
    group[order] = first[np.cumsum(new) - 1]
    place[order] = np.arange(n, dtype=np.int32)
    before = np.full(n, -1, np.int32)
    run = np.zeros(n, np.int32)
    most = np.zeros(n, np.int32)
    chosen = np.zeros(n, bool)
    top = bounds[1:].astype(np.int32).copy()
    live = np.arange(len(start))
    while len(live):
        high = top[live]
        low = group[sa[high - 1]]
        count = high - low
        s = sa[ragged(low, count)]
        high_of, low_of, start_of = np.repeat(high, count), np.repeat(low, count), np.repeat(start[live], count)
        p = s - 1
        todo = np.flatnonzero(p >= start_of)
        p[p < start_of] = -1
        while len(todo):  # jump over what is greater
            todo = todo[group[p[todo]] >= high_of[todo]]
            p[todo] = before[p[todo]]
            todo = todo[p[todo] >= 0]
        run[s] = 1
        inside = np.flatnonzero(p >= 0)
        inside = inside[group[p[inside]] == low_of[inside]]
        before[s] = p
        while len(inside):  # members that follow members: double the jump until it leaves the group
            q = before[s[inside]]
            r, b = run[q].copy(), before[q].copy()
            run[s[inside]] += r
            before[s[inside]] = b
            inside = inside[b >= 0]
            inside = inside[group[before[s[inside]]] == low_of[inside]]
        p, k = before[s], run[s]
        p, k = p[p >= 0], k[p >= 0]
        roots = p[k == 1]
        if len(roots):
            many = int(k.max())
            if many == 1:
                _move(roots, sa, place, group, size, chosen)
            else:
                order = np.argsort(k, kind="stable")
                most[p[order]] = k[order]
                need = most[roots]
                for x in np.unique(need)[::-1]:
                    _move(roots[need == x], sa, place, group, size, chosen)
        top[live] = low
        live = live[low > start[live]]
    return _emit_in_step(group, before, bounds)


def _move(p: np.ndarray, sa: np.ndarray, place: np.ndarray, group: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> None:
    """Moves the suffixes to the upper ends of their groups, where those of one group form a new group."""
    g = group[p]
    order = np.argsort(g, kind="stable")
    p, g = p[order], g[order]
    at = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    count = np.diff(np.r_[at, len(g)]).astype(np.int32)
    own = g[at]
    fresh = own + size[own] - count
    fresh_of = np.repeat(fresh, count)
    chosen[p] = True
    tail = sa[ragged(fresh, count)]
    away = tail[~chosen[tail]]
    chosen[p] = False
    come = p[place[p] < fresh_of]
    a, b = place[come].copy(), place[away].copy()
    sa[a], sa[b] = away, come
    place[away], place[come] = a, b
    size[own] -= count
    size[fresh] = count
    group[p] = fresh_of


def _emit_in_step(group: np.ndarray, before: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n, start, length = len(group), bounds[:-1], np.diff(bounds)
    sa, free, placed = np.empty(n, np.int32), np.arange(n, dtype=np.int32), np.zeros(n, bool)
    last = (bounds[1:] - 1).astype(np.int32)
    sa[start] = last
    placed[last] = True
    free[group[last]] += 1
    order = np.argsort(length, kind="stable")
    base, length = start[order], length[order]
    for i in range(int(length[-1]) if len(length) else 0):
        base = base[np.searchsorted(length, i, "right") :]
        length = length[np.searchsorted(length, i, "right") :]
        s = sa[base + i] - 1
        s = s[s >= base]
        s = s[~placed[s]]
        while len(s):
            g = group[s]
            f = free[g]
            sa[f] = s
            free[g] = f + 1
            placed[s] = True
            s = before[s]
            s = s[s >= 0]
            s = s[~placed[s]]
    return sa
