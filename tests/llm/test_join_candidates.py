"""Sets that share few n-grams by chance are not compared; those that are linked all are, however short or many they are."""

import random

import numpy as np


def test_one_shared_gram_is_no_candidate():
    from millrace.llm import prefix_tree_join as P

    sizes = 100 << 32 | 125
    held = lambda tokens: np.array([[t, s, sizes] for t in tokens for s in (11, 12)], np.uint64)
    links = lambda tokens: [r for b in P._shard_links([held(tokens)], [np.zeros((0, 2), np.uint64)]) for r in b.to_pylist() if r.get("k", 1) >= r.get("need", 1)]
    assert links([7]) == [] and links([7, 8, 9]) == []
    assert [(r["u"], r["v"]) for r in links([6, 7, 8, 9])] == [(11, 12)]
    many = np.array([[7, s, sizes] for s in range(1, 60)], np.uint64)
    assert len(list(P._shard_links([many], [np.zeros((0, 2), np.uint64)]))[0]["u"]) == 58


def test_join_of_short_and_many_sets(spark):
    from millrace.llm.prefix_tree_join import prefix_tree_join

    r = random.Random(5)
    word = lambda: r.choice("abcdefgh")
    rows = [" ".join(word() for _ in range(r.randint(1, 9))) for _ in range(250)]
    for n, copies in ((12, 6), (30, 40), (60, 25), (200, 12)):
        one = [r.choice("abcdefghijklmnopqrstuvwxyz") + word() for _ in range(n)]
        for _ in range(copies):
            t = list(one)
            for _ in range(r.randint(0, 1 + n // 60)):
                t[r.choice([0, -1, r.randrange(n)])] = word()
            rows.append(" ".join(t))
    r.shuffle(rows)
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} for w in (t.split() for t in rows)]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in prefix_tree_join(docs).collect()}
    assert got == {k: (len(sets[k]), find(k)) for k in range(len(rows))}
