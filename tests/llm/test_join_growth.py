"""What op5 sends follows the input: no groups by quoted passages, one row of equal sets, and no square of a large group."""

import itertools
import random

import numpy as np
import pyarrow as pa


def _near(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def _expected(texts):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if _near(sets[a], sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in range(len(texts))}


def _got(spark, texts, parts=5):
    from millrace.llm.prefix_tree_join import prefix_tree_join

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    return {x.doc_id: (x.n_shingles, x.component_id) for x in prefix_tree_join(docs).collect()}


def _inputs(monkeypatch, step):
    """Rows that reach one of the join's steps over batches, at each use."""
    from millrace.llm import prefix_tree_join as P

    seen, old = [], P.mapped

    def counting(df, mapper, *rest):
        if mapper.__name__ == step:
            seen.append(df.collect())
        return old(df, mapper, *rest)

    monkeypatch.setattr(P, "mapped", counting)
    return seen


def test_quoted_passages_make_no_groups(spark, monkeypatch):
    """Texts of four passages, of which eighteen have the same rarest one; only the contents of near copies are sent."""
    r = random.Random(3)
    passage = lambda n: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n))
    rare, common = [passage(50) for _ in range(3)], [passage(60) for _ in range(6)]
    texts = [" ".join([one, *some]) for one in rare for some in list(itertools.combinations(common, 3))[:18]]
    texts += [texts[0] + " end", texts[40] + " end"]
    sent = _inputs(monkeypatch, "joined")
    assert _got(spark, texts) == _expected(texts)
    assert len(sent[0]) == 4


def test_equal_sets_are_read_once(spark, monkeypatch):
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefghijkl") + r.choice("mnopqrst") for _ in range(120)) for _ in range(20)]
    rows = [t for t in texts for _ in range(6)]
    sent = _inputs(monkeypatch, "grouped")
    assert _got(spark, rows) == {k: (len({tuple(t.split()[j : j + 5]) for j in range(116)}), k // 6 * 6) for k, t in enumerate(rows)}
    assert sum(len(x.blob) for x in sent[0]) == 0


def test_parities_never_rule_out_a_link():
    from millrace.llm import prefix_tree_join as P

    r, ruled_out = random.Random(6), 0
    for _ in range(300):
        n = r.choice([1, 3, 9, 40, 63, 64, 70, 128, 200, 500, 520])
        a = [f"w{r.randrange(10**9)}" for _ in range(n + 4)]
        b = list(a)
        for _ in range(r.randint(0, 1 + n // 20)):
            b[r.randrange(len(b))] = "x"
        b = b[: r.randint(max(5, len(b) * 3 // 4), len(b))]
        if r.random() < 0.2:
            b = [f"v{r.randrange(10**9)}" for _ in a]
        grams, off, _ = P.ngram_sets(pa.array([" ".join(a), " ".join(b)]), 5)
        x, y = P.parities(grams, off).to_pylist()
        size = np.diff(off)
        fits = bool(P.may_link(size[:1], size[1:], [x], [y])[0])
        assert fits or not _near(set(grams[: off[1]].tolist()), set(grams[off[1] :].tolist()))
        ruled_out += not fits
    assert ruled_out > 50


def test_large_groups_are_compared_once_in_each_block(spark, monkeypatch):
    """A group of forty blocks: its texts are sent about once, where each pair of blocks would send them forty times."""
    from millrace.llm import prefix_tree_join as P

    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    base = [word() for _ in range(200)]
    texts = []
    for k in range(120):
        t = list(base)
        t[r.choice([0, 199])] = word()
        if k % 3 == 0:
            t[r.randrange(200)] = word()
        texts.append(" ".join(t))
    # a chain that leaves the group step by step, so that only neighbours are linked
    for _ in range(12):
        t = texts[-1].split()
        texts.append(" ".join(t[12:] + [word() for _ in range(12)]))
    monkeypatch.setattr(P, "BLOCK_GRAMS", 650)
    monkeypatch.setattr(P, "HUBS", 4)
    sent = _inputs(monkeypatch, "joined")
    assert _got(spark, texts) == _expected(texts)
    blocks = len({x.block for x in sent[0]})
    assert blocks > 30 and len(sent[0]) < 132 + 8 * blocks
    assert len(sent) == 2 and sum(map(len, sent)) < 132 * blocks / 3
