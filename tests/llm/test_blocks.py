"""Centroids, hard negatives and mixed sources against brute force in Python's integers and fractions: nulls, other dimensions,
values that are not finite or beyond float64's whole numbers, repeated rows, ties, clashing columns, empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, key long, id long, d int, cell int, rank int, score long, block int, side int, low int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *range(9)) for r in rows], SCHEMA).repartition(3)


def same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


def vectors(huge=False):
    rng = random.Random(5)
    centre = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    out = [(k, [x + rng.gauss(0, 0.2) for x in rng.choice(centre)], rng.choice([0, 0, 0, 1, 2, 3, 4])) for k in range(160)]
    out += [out[3], out[3], (3, out[4][1], 0), (None, out[5][1], 1), (200, None, 1), (201, [1.0] * 5, 2), (202, [], 0), (203, [float("nan")] * 6, 0), (204, [math.inf] + [0.0] * 5, 0), (205, [None] + [0.0] * 5, 0), (206, out[6][1], None), (210, [0.5] * 6, 2), (300, [0.5] * 6, 2), (301, [0.25] * 6, 2), (302, [0.25] * 6, 3), (303, [1.0] * 5, 0), (400, [2.0] * 5, 2)]
    return out + ([(500, [1e12] * 6, 1), (501, [-3e17, *[1e3] * 5], 0), (502, [1e18] * 6, 0), (503, [1e18, *[0.5] * 5], 1)] if huge else [])


def kept(rows, dimension=None):
    return [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and (dimension is None or len(r[1]) == dimension)]


def floored(v, scale):
    return [math.floor(Fraction(x) * scale) for x in v]


def clusters(rows, k, rounds, scale, dimension):
    rows = [(r[0], floored(r[1], scale)) for r in sorted(kept(rows, dimension), key=lambda r: ((1, "") if r[0] is None else (0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()), r[1]))]
    centroids = [v for _, v in rows[:k]]
    for turn in range(rounds + 1):
        found = []
        for i, v in rows:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(centroids))
            found.append((i, c, d))
        if turn < rounds:
            for c in range(len(centroids)):
                own = [v for (_, v), (_, at, _) in zip(rows, found, strict=True) if at == c]
                if own:
                    centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    fits = lambda x: x if x < 1 << 63 else None
    each = collections.Counter()
    for _, c, d in found:
        each[c] += d
    return [(i, c, fits(d), fits(each[c]), fits(sum(each.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in found]


@pytest.mark.parametrize(("huge", "k"), [(False, 5), (True, 5), (False, 500)])
def test_clusters(spark, huge, k):
    from millrace.llm.centroids import cluster_vectors

    rows = vectors(huge)
    got = cluster_vectors(frame(spark, rows), k=k, rounds=3, scale=64, dimension=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    same(got.collect(), clusters(rows, k, 3, 64, 6))


def test_clusters_of_nothing(spark):
    from millrace.llm.centroids import cluster_vectors

    assert cluster_vectors(frame(spark, []), dimension=6).collect() == []
    assert cluster_vectors(frame(spark, vectors()[160:170]), dimension=64).collect() == []


@pytest.mark.parametrize("top", [1 << 20, 1 << 26, 1 << 40])
def test_products_are_exact(top):
    """Below 2**53 in float64, below 2**63 in int64, else in Python's integers: always what Python says."""
    from millrace.llm.integer_blocks import decoded, distances, encoded, products

    rng = random.Random(top)
    a, b = ([[rng.randrange(-top, top) for _ in range(33)] for _ in range(n)] for n in (7, 5))
    x, y = np.array(a, float), np.array(b, float)
    expected = [[sum(p * q for p, q in zip(r, s, strict=True)) for s in b] for r in a]
    assert products(x, y).tolist() == expected
    assert distances(x, y).tolist() == [[sum((p - q) ** 2 for p, q in zip(r, s, strict=True)) for s in b] for r in a]
    assert decoded(encoded(products(x, y))).tolist() == expected


def negatives(rows, positives, most, window, scale):
    live = [(r[0], r[2], floored(r[1], scale)) for r in {(r[0], r[2], tuple(r[1])): r for r in kept(rows) if r[0] is not None and r[2] is not None}.values()]
    out = []
    for a in live:
        if a[0] % 100:
            continue
        scored = [(sum(p * q for p, q in zip(a[2], r[2], strict=True)), r) for r in live if r is not a and len(r[2]) == len(a[2])]
        scored = sorted(((s, r) for s, r in scored if abs(s) < 1 << 63), key=lambda x: (-x[0], x[1][0]))
        for ps, p in [x for x in scored if x[1][1] == a[1]][:positives]:
            fits = [(s, r) for s, r in scored if r[1] != a[1] and window[0] * ps <= 100 * s <= window[1] * ps][:most]
            out += [(a[0], p[0], k + 1, r[0], ps, s) for k, (s, r) in enumerate(fits)]
    return out


@pytest.mark.parametrize(("huge", "block", "chunk"), [(False, None, 32), (False, 16, 2), (True, 16, 4)])
def test_hard_negatives(spark, huge, block, chunk):
    """Kinds with blocks of their own and pools, one and several chunks, vectors of two dimensions, scores beyond float64."""
    from millrace.llm.hard_negatives import mine_hard_negatives

    rows = vectors(huge)
    got = mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, positives=3, negatives=4, scale=256, chunk=chunk, block_rows=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = negatives(rows, 3, 4, (30, 90), 256)
    assert len(expected) > 8
    same(got.collect(), expected)


def test_hard_negatives_of_nothing(spark):
    from millrace.llm.hard_negatives import mine_hard_negatives

    assert mine_hard_negatives(frame(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert mine_hard_negatives(frame(spark, vectors()), F.col("vec_id") < 0).collect() == []


# mixed sources

DOCS = "doc_id long, text string, source string, size long, u long, w long, row long, s int, name string, place long, taken long"


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "n", 6, 7) for r in rows], DOCS).repartition(3)


def some_documents():
    rng = random.Random(8)
    out = [(k, " ".join(["w\t"] * rng.choice([0, 1, 3, 10, 40, 200])), rng.choice(["a", "a", "a", "b", "B", "é", None, "z"])) for k in range(300)]
    return out + [out[5]] * 9 + [(None, "x y z", "a")] * 40 + [(None, None, None), (7, "another  text\n", "b"), (900, "", "empty"), (901, None, "empty"), (902, "one " * 900, "one")]


def expected_targets(rows, weights=(3, 1, 2), percent=150, most=2):
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, cut = Fraction(percent * sum(sizes.values()), 100), set()
    while True:
        free = [s for s in names if s not in cut]
        rest = total - sum(most * sizes[s] for s in cut)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return sizes, share | {s: Fraction(most * sizes[s]) for s in cut}
        cut |= over


@pytest.mark.parametrize("few", [4096, 0])
def test_mixed_sources(spark, few):
    """Targets as fractions; words near them; whole copies; the same rows whatever the partitions, also where ranges are cut to the end."""
    from millrace.llm.source_mix import mix_sources

    rows = some_documents()
    got = mix_sources(documents(spark, rows), few=few)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    sizes, target = expected_targets(rows)
    source = collections.Counter((i, len((t or "").split()), sizes[s], float(target[s])) for i, t, s in rows)
    found = got.collect()
    assert collections.Counter((r.doc_id, r["size"], r.source_size, r.target) for r in found) == source
    taken = collections.Counter()
    for r in found:
        assert not r["size"] and not r.taken or r.taken in (k * r["size"] for k in (0, 1, 2))
        taken[r.source_size, r.target] += r.taken
    for s, n in sizes.items():
        largest = max(len((t or "").split()) for _, t, x in rows if x == s)
        assert abs(taken[n, float(target[s])] - target[s]) <= max(largest / 2, 1)
    same(mix_sources(documents(spark, rows[::-1]).repartition(5), few=7).collect(), found)


def test_pareto_weights(spark):
    """Documents of greater weight are taken more often, in the odds that they are given; those without weight come last."""
    from millrace.llm.source_mix import mix_sources

    rows = [(k, "a b c d", "s") for k in range(2000)]
    weight = F.element_at(F.array(F.lit(0.0), F.lit(1.0), F.lit(3.0), F.lit(None).cast("double")), (F.col("doc_id") % 4 + 1).cast("int"))
    found = mix_sources(documents(spark, rows), weights=(1,), percent=20, most=1, weight=weight).collect()
    share = [sum(r.taken for r in found if r.doc_id % 4 == k) / 2000 for k in range(4)]
    assert share[0] == share[3] == 0
    assert abs(share[1] - 0.2) < 0.06 and abs(share[2] - 0.6) < 0.06


def test_mix_of_nothing_and_bad_settings(spark):
    from millrace.llm.source_mix import mix_sources

    assert mix_sources(documents(spark, [])).collect() == []
    assert [tuple(r) for r in mix_sources(documents(spark, [(1, None, None), (None, "", "a")])).collect()] == [(1, 0, 0, 0.0, 0), (None, 0, 0, 0.0, 0)]
    with pytest.raises(ValueError):
        mix_sources(documents(spark, []), percent=300)
