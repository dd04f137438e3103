"""The corpus operators against brute force, on a small table with nulls, empty and long texts, copies, repeated rows and columns
whose names clash with inner ones; and on empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

VOCAB = ["the", "of", "and", "ation", "ble", "onth", "éle", "Thth", "er", "in,", "on.", "ß", "a", "anwh", "reou", "hesh"]
SCHEMA = "doc_id long, text string, key long, m long, n int, h long, id long, spans string, `set` long, `group` long, slice int, kept string, row string"


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(n))


def make_texts():
    rng = random.Random(11)
    shared, long = prose(rng, 80), prose(rng, 3000)
    near = prose(rng, 120).split()
    out = [prose(rng, rng.randint(1, 200)) for _ in range(12)]
    out += [out[0], out[0], prose(rng, 20) + " " + shared + " " + prose(rng, 30), shared, prose(rng, 60) + "\n" + shared]
    for k in range(6):
        w = list(near)
        w[rng.randrange(len(w))] = f"edit{k}"
        out.append(" ".join(w))
    out += ["", None, "one two", "One  two", "one two", " \t\n", "x", "ab" * 700, "=" * 900, long, long[5000:5600] + " tail", shared.upper()]
    return out


@pytest.fixture(scope="module")
def rows():
    texts = make_texts()
    out = [(k * 3, t) for k, t in enumerate(texts)]
    return out + [out[2], out[13], (None, texts[3]), (None, None), (9, "another text under a known id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, "s", 6, 7, 8, "k", "r") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def data(t):
    return (t or "").encode()


def same(got, expected):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, expected))


def cut_out(n, gone, join):
    return join(k for k in range(n) if not gone[k])


def test_suffix_array_dedup(docs, rows):
    from millrace.llm.suffix_dedup import suffix_array_dedup

    count = collections.Counter(data(t)[k : k + 200] for _, t in rows for k in range(len(data(t)) - 199))
    expected = []
    for i, t in rows:
        x = data(t)
        gone = bytearray(len(x))
        for k in range(len(x) - 199):
            if count[x[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(x)))
        expected.append((i, len(x), sum(gone), spans, hashlib.sha256(cut_out(len(x), gone, lambda ks: bytes(x[k] for k in ks))).hexdigest()))
    same(suffix_array_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), expected)


def test_substring_dedup(docs, rows):
    from millrace.llm.substring_dedup import substring_dedup

    least, far = {}, 1 << 62
    for i, t in rows:
        w = data(t).split()
        for k in range(len(w) - 49):
            x = tuple(w[k : k + 50])
            least[x] = min(least.get(x, far), far if i is None else i)
    expected = []
    for i, t in rows:
        w = data(t).split()
        gone = [0] * len(w)
        for k in range(len(w) - 49):
            if least[tuple(w[k : k + 50])] < (far if i is None else i):
                gone[k : k + 50] = [1] * 50
        expected.append((i, len(w), sum(gone), hashlib.sha256(cut_out(len(w), gone, lambda ks: b" ".join(w[k] for k in ks))).hexdigest()))
    same(substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), expected)


@pytest.fixture(scope="module")
def variants(spark):
    """Copies with an edit each, a shared passage inside, and copies of copies: one anchor has many different segments."""
    rng = random.Random(12)
    w = prose(rng, 160).split()
    out = []
    for k in range(60):
        v = list(w)
        v[rng.randrange(len(v))] = f"edit{k}"
        out += [" ".join(v)] * (1 + (k % 7 == 0))
    return spark.createDataFrame(list(enumerate(out)), "doc_id long, text string").repartition(3)


def test_anchors_with_many_segments(variants, monkeypatch):
    from millrace.llm import segments as S
    from millrace.llm.substring_dedup import substring_dedup
    from millrace.llm.suffix_dedup import suffix_array_dedup

    both = lambda: [[tuple(r) for r in f(variants).drop("key", "kept").collect()] for f in (suffix_array_dedup, substring_dedup)]
    whole = both()
    assert all(sum(r[2] > 0 for r in x) > 30 for x in whole)
    cut = []
    monkeypatch.setattr(S, "HOT", 4)
    indexed = S._indexed
    monkeypatch.setattr(S, "_indexed", lambda *a: (cut.append(a[5]), indexed(*a))[1])
    for x, y in zip(both(), whole, strict=True):
        same(x, y)
    assert max(cut) > 150


def test_segments_that_share_a_line(spark, monkeypatch):
    """One line of 151 bytes (30 words) in every document: no index gets more segments of an anchor than the limit, nothing is removed
    but what windows of the planted copies cover, and two rows are made for a segment and step at most."""
    from millrace.llm import segments as S
    from millrace.llm.substring_dedup import substring_dedup
    from millrace.llm.suffix_dedup import suffix_array_dedup

    rng = random.Random(3)
    line = " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(30)) + "\n\n"
    assert len(line) == 151
    out = ["".join(rng.choice("klmnopqrst ") for _ in range(200)) + " " + line + "".join(rng.choice("klmnopqrst ") for _ in range(200)) for _ in range(700)]
    out[9] = out[4][:230] + out[9][230:]  # 230 bytes in common, up to within the line
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(S, "HOT", 64)
    shards, groups, made = S._shards, [], []

    def watched(rows, resolve, weight):
        groups.append(rows.groupBy("m").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])
        made.append(rows.count())
        return shards(rows, resolve, weight)

    monkeypatch.setattr(S, "_shards", watched)
    removed = {r.doc_id: r.n_removed for r in suffix_array_dedup(docs).collect() if r.n_removed}
    assert set(removed) == {4, 9} and removed[4] == removed[9] >= 230
    assert max(groups) <= 64 and len(groups) > 1 and sum(made) < 700
    groups.clear(), made.clear()
    assert substring_dedup(docs, window=34, gram=16).where("n_removed > 0").count() == 1
    assert max(groups) <= 64 and len(groups) > 1


def test_texts_longer_than_a_piece(docs, monkeypatch):
    """Rows that are cut into pieces, at any place, lose nothing that whole ones don't."""
    from millrace.llm import segments as S
    from millrace.llm.substring_dedup import substring_dedup
    from millrace.llm.suffix_dedup import suffix_array_dedup

    both = lambda: [[tuple(r) for r in f(docs).drop("key", "kept").collect()] for f in (suffix_array_dedup, substring_dedup)]
    whole = both()
    monkeypatch.setattr(S, "PIECE", 333)
    for x, y in zip(both(), whole, strict=True):
        same(x, y)


def test_halves_of_segments():
    """Each window is in one half, and its larger core lies inside it."""
    import numpy as np

    from millrace.llm.segments import halves

    for window, core in ((200, 100), (200, 175), (200, 188), (200, 199), (50, 24), (50, 37), (50, 49)):
        for n in range(1, window - core + 2):
            for at in range(n - 1, window - core + 1):
                seen = []
                half = (window - core + 1) // 2
                for r, start, count, place in halves(np.array([n]), np.array([at]), window, core):
                    for s, c, p in zip(start.tolist(), count.tolist(), place.tolist(), strict=True):
                        seen += range(s, s + c)
                        assert all(k <= p and p + core + half <= k + window for k in range(s, s + c))
                assert seen == list(range(n))


def test_prefix_tree_join(docs, rows):
    from millrace.llm.prefix_tree_join import prefix_tree_join

    sets = []
    for _, t in rows:
        w = data(t).lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    expected = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        expected.append((i, len(sets[k]), min(ids) if ids else None))
    same(prefix_tree_join(docs).select("doc_id", "n_shingles", "component_id").collect(), expected)


def test_blocks_of_large_groups(docs, rows, monkeypatch):
    from millrace.llm import prefix_tree_join as P

    whole = P.prefix_tree_join(docs).select("doc_id", "n_shingles", "component_id").collect()
    monkeypatch.setattr(P, "BLOCK_GRAMS", 200)
    same(P.prefix_tree_join(docs).select("doc_id", "n_shingles", "component_id").collect(), whole)


def test_packing(docs, rows):
    import numpy as np
    from tokenizers import Tokenizer

    from millrace.llm.packing import best_fit_packing
    from millrace.llm.queries import vocabulary

    path = vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    expected = []
    for i, x in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(i, k, a, len(ids[a : a + 256]), zlib.crc32(ids[a : a + 256].tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    got = best_fit_packing(docs, path, size=256, open_sequences=4).collect()
    same([r[:5] for r in got], expected)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 256


def test_packing_by_any_tokenizer(docs, tmp_path):
    import json

    from millrace.llm import packing as K
    from millrace.llm.queries import vocabulary

    path = vocabulary("word_bpe_49k.json")
    assert K.by_word(path) and not K.by_word(vocabulary("byte_bpe_50k.json"))
    settings = json.loads(open(path, encoding="utf-8").read())
    settings["normalizer"]["normalizers"].append({"type": "NFC"})  # the same ids by other settings
    other = tmp_path / "other.json"
    other.write_text(json.dumps(settings))
    assert not K.by_word(str(other))
    cut = lambda p: [tuple(r) for r in K.pieces(docs, p, 256).drop("ids").collect()]
    same(cut(str(other)), cut(path))


def test_token_counts(docs, rows):
    from millrace.llm.token_counts import token_counts

    starting, continuing = {b"the", b"o", b"on", b"a"}, {b"the", b"n", b"f", b"a", b"t", b"i", b"o", b"on", b"\xc3\xa9le"}

    def count(word):
        at = n = 0
        while at < len(word):
            size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in (continuing if at else starting)), 0)
            if not size:
                return 1
            at, n = at + size, n + 1
        return n

    same(token_counts(docs, starting, continuing).collect(), [(i, len(data(t)), len(data(t).split()), sum(map(count, data(t).split()))) for i, t in rows])


def test_context_tree(docs, rows):
    from millrace.llm.context_tree import DEPTH, score_texts

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens, count, children = collections.Counter(), collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)

    def bits(x):
        s = bytes(DEPTH) + data(x).lower() + b"\0"
        for p in range(DEPTH, len(s)):
            context = s[p - DEPTH : p][::-1]
            for j in range(8):
                yield [(context[:k], 1 << j | s[p] >> 8 - j) for k in range(DEPTH + 1)], s[p] >> 7 - j & 1

    for i, x in rows:
        if not held(i):
            tokens.update([*data(x).lower().split(), 0])
            for nodes, bit in bits(x):
                for k, node in enumerate(nodes):
                    count[node][bit] += 1
                    if k:
                        children[nodes[k - 1]].add(node)
    own = {n: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for n, (a, b) in count.items()}
    mixed, weight = {}, {}
    for n in sorted(count, key=lambda n: -len(n[0])):
        below = sum(mixed[c] for c in children[n])
        top = max(own[n], below)
        mixed[n] = own[n] if len(n[0]) == DEPTH else math.log(0.5) + top + math.log(math.exp(own[n] - top) + math.exp(below - top))
        weight[n] = 1 if len(n[0]) == DEPTH else 1 / (1 + math.exp(min(700, below - own[n])))
    size, kinds = sum(tokens.values()), len(tokens)
    expected = []
    for i, x in rows:
        total = 0
        for nodes, bit in bits(x):
            p = None
            for n in reversed(nodes):
                if n in count:
                    kt = (count[n][bit] + 0.5) / (sum(count[n]) + 1)
                    p = kt if p is None else weight[n] * kt + (1 - weight[n]) * p
            total += math.log10(0.5 if p is None else p)
        w = [*data(x).lower().split(), 0]
        base = sum(math.log10((tokens[t] + 1) / (size + kinds + 1)) for t in w)
        expected.append((i, held(i), len(w), sum(tokens[t] > 0 for t in w), size, f"{base:.6g}", f"{total:.6g}"))
    got = score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()
    same([(*r[:5], f"{r.base_score:.6g}", f"{r.score:.6g}") for r in got], expected)


def test_context_tree_large_subtrees(spark, docs, monkeypatch):
    import numpy as np

    from millrace.llm import context_tree as C

    a, b, c = (x.ravel().astype(np.uint64) for x in np.meshgrid(*[np.arange(41)] * 3))
    place = lambda *x: sum(np.uint64(1 << 8 * k) * np.asarray(v, np.uint64) for k, v in enumerate(reversed(x)))
    deep = place(a, b, 9, 7, 8, c)  # 68,921 runs below three context bytes, 1,681 below four
    wide = place(a, b, c, 5, 6, 65 + (a + b * c) % np.uint64(3))  # 68,921 runs below two context bytes, 1,681 below three
    few = place(a[:500], 1, b[:500], 2, c[:500], 4)
    run = np.unique(np.concatenate([deep, wide, few]))
    n = np.arange(len(run)) * 7 % 5  # some are not seen in training
    counts = spark.createDataFrame(list(zip(run.view(np.int64).tolist(), n.tolist(), strict=True)), "key long, n long")
    expected = dict(zip(run.view(np.int64).tolist(), C.log10_of(run, C.levels(run, n, 0)).tolist(), strict=True))
    got = {r.key: r.value for r in C.learned(counts).collect()}
    assert got.keys() == expected.keys() and max(abs(got[k] - expected[k]) for k in got) < 1e-9

    score = lambda: [(*r[:5], f"{r.base_score:.6g}", f"{r.score:.6g}") for r in C.score_texts(docs, F.col("doc_id") % 7 == 2).collect()]
    whole = score()
    monkeypatch.setattr(C, "SUBTREE", 20)
    same(score(), whole)


def test_context_tree_parts(spark, monkeypatch):
    from millrace.llm import context_tree as C

    few = [(1, "unique zebra text"), (2, "more of this"), (None, "unique zebra"), (None, None), (None, "unique zebra"), (2, "more of this")]
    docs = spark.createDataFrame(few, "doc_id long, text string")
    score = lambda held_out: [(*r[:5], f"{r.base_score:.6g}", f"{r.score:.6g}") for r in C.score_texts(docs, held_out).collect()]
    null, one = F.col("doc_id").isNull(), F.col("doc_id") == 1
    whole = [score(null), score(one)]
    assert sorted(r[3] for r in whole[0] if r[0] is None) == [1, 3, 3]  # words that training has once are known
    monkeypatch.setattr(C, "PART", 16)
    for passes in (1000, 2):  # one pass for each table, or a join of all runs
        monkeypatch.setattr(C, "MOST_PASSES", passes)
        for w, held_out in zip(whole, (null, one), strict=True):
            assert len(w) == len(few)
            same(score(held_out), w)


def test_context_tree_rare_words_and_depths(docs, monkeypatch):
    from millrace.llm import context_tree as C

    score = lambda **more: [(*r[:5], f"{r.base_score:.6g}", f"{r.score:.6g}") for r in C.score_texts(docs, F.col("doc_id") % 7 == 2, **more).collect()]
    whole, deep = score(), score(depth=7)
    assert [r[:6] for r in sorted(whole, key=str)] == [r[:6] for r in sorted(deep, key=str)] and whole != deep
    monkeypatch.setattr(C, "SUBTREE", 20)
    same(score(depth=7), deep)
    monkeypatch.setattr(C, "PART", 300)  # words are in one table of so many entries, and joined beyond it
    monkeypatch.setattr(C, "MOST_PASSES", 1)
    same(score(), whole)
    with pytest.raises(ValueError):
        C.score_texts(docs, F.lit(False), depth=8)


def test_edit_matching(spark, docs, rows):
    from millrace.llm.edit_matching import contaminated, decontaminate, normal

    item = rows[15][1][:200]
    changed = item[:50] + "Zz" + item[52:120] + item[123:]
    bench = spark.createDataFrame([(1, changed), (2, changed), (2, " " + changed.encode().upper().decode()), (3, None), (4, ""), (5, "nowhere to be found in these texts")], "item_id long, text string")

    def distance(p, t):
        last = [0] * (len(t) + 1)
        for k, c in enumerate(p, 1):
            now = [k]
            for j, x in enumerate(t, 1):
                now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (c != x)))
            last = now
        return min(last)

    p = normal(changed.encode())
    found = [(i, distance(p, normal(data(t)))) for i, t in rows if len(data(t)) < 4000]
    expected = [(i, n, d) for i, d in found for n in (1, 2) if d <= int(len(p) * 0.08)]
    assert expected
    same(contaminated(docs, bench).select("doc_id", "item_id", "distance").collect(), expected)
    assert decontaminate(docs, bench).count() == len(rows) - len(expected) // 2
    assert decontaminate(docs, bench).columns == docs.columns


def test_items_without_id(spark, docs, rows):
    from millrace.llm.edit_matching import contaminated, decontaminate

    items = [rows[k][1][:150] for k in (5, 6, 15)]
    bench = spark.createDataFrame([(None, items[0]), (None, items[1]), (7, items[1]), (8, items[2]), (None, items[2][10:]), (None, None)], "item_id long, text string")
    got = contaminated(docs, bench).select("doc_id", "item_id", "distance").collect()
    holds = lambda x: [i for i, t in rows if data(x).lower() in data(t).lower()]
    exact = [(i, n, 0) for x, n in ((items[0], None), (items[1], 7), (items[1], None), (items[2], 8), (items[2][10:], None)) for i in holds(x)]
    same([r for r in got if not r.distance], exact)
    assert holds(items[0]) and decontaminate(docs, bench.where("item_id is null").limit(1)).count() < len(rows)


def test_decontaminate_by_parts(spark, docs, rows, monkeypatch):
    from millrace.llm import edit_matching as E

    items = [(k, rows[k][1][:150]) for k in (3, 5, 6, 13, 15)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(E.decontaminate(docs, bench).collect(), key=str)
    pairs = E.contaminated(docs, bench).collect()
    assert 0 < len(whole) < len(rows)
    monkeypatch.setattr(E, "PART_BYTES", 200)
    monkeypatch.setattr(E, "FEW_ITEMS", 0)
    assert len(list(E.item_parts(E.benchmark_items(bench, "item_id", "text")))) > 1
    got = E.decontaminate(docs, bench)
    assert sorted(got.collect(), key=str) == whole and got.columns == docs.columns
    same(E.contaminated(docs, bench).collect(), pairs)


def test_neighbours(spark, monkeypatch):
    from millrace.llm import block_join as B

    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(60)]
    rows += [(60, rows[20][1]), (61, rows[20][1]), (20, rows[20][1]), (20, [x + 0.01 for x in rows[20][1]]), (40, [3.0] * 8)]
    bad = [(62, None), (63, []), (64, [0.0] * 8), (65, [float("nan")] * 8), (66, [1.0, None]), (None, [1.0] * 8), (80, [1.0] * 4), (67, [2.0] * 4)]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, key long")
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    pool = sorted({(i, tuple(v)) for i, v in rows + bad[-2:]})
    expected = []
    for q in pool:
        if q[0] % 20 == 0:
            best = sorted((-dot(q[1], v), i) for i, v in pool if (i, v) != q and len(v) == len(q[1]))[:5]
            expected += [(q[0], k, i, round(-s, 9)) for k, (s, i) in enumerate(best, 1)]
    found = lambda: [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in B.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=5).collect()]
    same(found(), expected)
    for name, value in (("LEAST", 8), ("TILE", 4), ("MOST", 3), ("STRIPE_BYTES", 600)):  # many stripes, tiles and parts of pairs
        monkeypatch.setattr(B, name, value)
        same(found(), expected)


def test_toxicity(spark):
    from millrace.llm.toxicity import toxicity, train, without_toxic

    rng = random.Random(5)
    bad = ["grumfle", "snortch", "blaggard"]
    rows = []
    for k in range(400):
        w = prose(rng, rng.randint(20, 160)).split()
        y = int(k % 4 == 0)
        for _ in range(y * 3):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((k, " ".join(w), y))
    docs = spark.createDataFrame([(i, t, None, 1) for i, t, _ in rows] + [(1000, None, None, 1), (1001, "", None, 1), (None, rows[0][1], None, 1)], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = {r.doc_id: r for r in toxicity(docs, model).collect()}
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got.values())
    test = [(got[i], y) for i, _, y in rows if got[i].held_out]
    assert sum(r.predicted == y for r, y in test) >= 0.95 * len(test)
    assert got[1000].score == got[1001].score < 0.5
    assert without_toxic(docs, model).columns == docs.columns
    one = train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity(docs, one).collect()} == {0.0}


def test_toxicity_learns_from_all_rows_of_an_id(spark):
    from millrace.llm.toxicity import training_rows

    rows = [(k, f"text {k} {j}") for k in range(1, 11) for j in range(3)] + [(1, "text 1 0"), (None, "of no id"), (2, None)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 11)] + [(4, 1), (6, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    trains = {k for k in range(1, 11) if zlib.crc32(str(k).encode()) % 5}
    texts, y, prior = training_rows(docs, labels, 1000, 1 << 20, "doc_id", "text", "doc_id", "toxic")
    expected = {(k, (t or "").encode()) for k, t in rows if k in trains}
    toxic = lambda k: int(k % 2 == 1 or k == 4)
    assert collections.Counter(zip(texts, y.tolist(), strict=True)) == collections.Counter((t, toxic(k)) for k, t in expected)
    assert prior == sum(map(toxic, trains)) / len(trains)
    few, y, _ = training_rows(docs, labels, 4, 1 << 20, "doc_id", "text", "doc_id", "toxic")
    assert sorted(y.tolist()) == [0] * 4 + [1] * 4 and len(few) == 8


def test_toxicity_network_against_plain_loops():
    """Scores as sums over single numbers, and gradients as differences of the loss."""
    import numpy as np

    from millrace.llm import toxicity as T

    rng = random.Random(4)
    texts = [(prose(rng, 9) + (" snortch, grumfle" if k % 2 else "")).lower().encode() for k in range(24)]
    model = T.fit(texts, np.array([k % 2 for k in range(24)]), 0.5, steps=3)
    p = {k: v.astype(float).tolist() for k, v in model.network.p.items()}
    sig, dot = (lambda x: 1 / (1 + math.exp(-x))), (lambda x, m, j: sum(a * r[j] for a, r in zip(x, m, strict=True)))
    data, off = np.frombuffer(texts[1], np.uint8), np.array([0, len(texts[1])])
    h, s, e, _ = T.bare_words(data, off)
    w = T.Words(data, h, s, e)
    x = model.vectors(w, model.facts(w))[0].astype(float)[w.index].tolist()
    states, H = {}, T.HIDDEN
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        now = [0.0] * H
        for t in order:
            g = [dot(x[t], p[f"W{d}"], j) + p[f"c{d}"][j] for j in range(3 * H)]
            u = [dot(now, p[f"U{d}"], j) for j in range(3 * H)]
            r, z = [sig(g[j] + u[j]) for j in range(H)], [sig(g[H + j] + u[H + j]) for j in range(H)]
            n = [math.tanh(g[2 * H + j] + r[j] * u[2 * H + j]) for j in range(H)]
            now = [z[j] * now[j] + (1 - z[j]) * n[j] for j in range(H)]
            states[d, t] = now
    both = [states["f", t] + states["b", t] for t in range(len(x))]
    told = [math.exp(sum(math.tanh(dot(b, p["A"], j) + p["a"][j]) * p["v"][j] for j in range(T.ATTENTION))) for b in both]
    logit = sum(a / sum(told) * sum(v * o for v, o in zip(b, p["o"], strict=True)) for a, b in zip(told, both, strict=True)) + p["b"][0]
    assert abs(model.score(data, off)[0] - sig(logit)) < 1e-4
    # gradients of a weighted sum of logits
    net, numbers = model.network, np.random.default_rng(2)
    steps, count = 6, 5
    inputs = numbers.standard_normal((steps, count, 6 * H)).astype(np.float32)
    mask = (np.arange(steps)[:, None] < np.array([6, 3, 1, 5, 6])).astype(np.float32)[:, :, None]
    weight = numbers.standard_normal(count).astype(np.float32)
    keep = {}
    net.forward(inputs, mask, keep)
    grads, dx = net.backward(weight, mask, keep)
    loss = lambda: float((net.forward(inputs, mask).astype(float) * weight).sum())
    for values, g in [(net.p[k], grads[k]) for k in ("Uf", "Ub", "A", "a", "v", "o", "b")] + [(inputs, dx)]:
        for at in numbers.choice(values.size, min(5, values.size), replace=False):
            old = values.flat[at]
            values.flat[at] = old + 0.01
            up = loss()
            values.flat[at] = old - 0.01
            down = loss()
            values.flat[at] = old
            assert abs((up - down) / 0.02 - np.asarray(g).flat[at]) < 2e-3 + 0.02 * abs(up - down) / 0.02


def test_toxicity_of_long_texts(spark, monkeypatch):
    from millrace.llm import toxicity as T

    rng = random.Random(6)
    rows = [(k, prose(rng, 30) + (" snortch" if k % 3 == 0 else "") + " " + prose(rng, 30), int(k % 3 == 0)) for k in range(240)]
    long = prose(rng, 40_000)
    rows += [(300 + k, long[: 60_000 * k] + " snortch " + long[60_000 * k :], 1) for k in range(2)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(400, long), (401, long + " snortch")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    texts, y, _ = T.training_rows(docs, labels, 1000, 16 << 20, "doc_id", "text", "doc_id", "toxic")
    assert sum(len(t) > 100_000 for t in texts) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in (300, 301))  # none is left out for its length
    few, _, _ = T.training_rows(docs, labels, 1000, 20_000, "doc_id", "text", "doc_id", "toxic")
    assert 0 < len(few) < len(texts)
    monkeypatch.setattr(T, "TOGETHER", 64)
    got = {r.doc_id: r.score for r in T.toxicity(docs, T.train(docs, labels)).collect()}
    assert got[401] > 0.5 > got[400] and got[300] > 0.5 and got[301] > 0.5


def test_long_regular_words():
    import numpy as np

    from millrace.llm.common import words

    w = b"a"
    for _ in range(11):
        w += w.translate(bytes.maketrans(b"ab", b"ba"))
    other = w.translate(bytes.maketrans(b"ab", b"ba"))
    text = b"x " + w + b" " + other + b" y " + w
    h, _, _, _ = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert h[1] != h[2] and h[1] == h[4] and len(set(h.tolist())) == 4


def test_main_text_is_linear():
    import time

    from millrace.llm.main_text import main_text

    n = 100_000
    for page in ("<div>a" * n, "<b><div>a" * n, "<div>" * n + "<li>x</li>" * n, "<div>" * n + "</section>" * n, "<a><b>x" * n, "<div class='notice'>a" * n):
        began = time.perf_counter()
        main_text(page)
        assert time.perf_counter() - began < 30  # a quadratic walk takes hours


def test_main_text_inside_names():
    from millrace.llm.main_text import main_text

    body = "".join(f"<p>Paragraph {k}, of the article, with words, commas, and more of them.</p>" for k in range(3))
    text = "\n".join(f"Paragraph {k}, of the article, with words, commas, and more of them." for k in range(3))
    for name in ("social-history", "alert-systems", "related_work", "promo-codes", "discussion-of-results"):
        assert main_text(f"<article>{body}<div class='{name}'>{body}</div></article>") == text + "\n" + text
    for name in ("social-links", "alert", "related-posts", "promo box", "cookie-notice", "notice"):
        assert main_text(f"<article>{body}<div class='{name}'>{body}</div></article>") == text


def test_main_text():
    from millrace.llm.main_text import main_text

    body = "".join(f"<p>Paragraph {k}, of the article, with words &amp; commas, and more of them.<p>" for k in range(3))
    page = f"<html><head><title>T</title><style>x</style></head><body><nav><a href=1>Home</a></nav><div class='ad'>Buy, buy, and buy some more of this.</div><article><h1>Title</h1>{body}</article><div id=comments><p>Nice, really nice, I like all of this very much.</p></div><footer>end</footer>"
    assert main_text(page) == "\n".join(["Title", *(f"Paragraph {k}, of the article, with words & commas, and more of them." for k in range(3))])
    assert main_text("") == main_text("<script>x</script><nav>a</nav>") == ""
    assert main_text("plain  text") == "plain text"


def test_main_text_in_named_wrappers():
    from millrace.llm.main_text import main_text

    body = "".join(f"<p>Paragraph {k}, of the article, with words, commas, and more of them.</p>" for k in range(3))
    text = "\n".join(f"Paragraph {k}, of the article, with words, commas, and more of them." for k in range(3))
    ad = "<div class='ad-box'><p>Buy, buy, and buy some more of this.</p></div>"
    talk = "<div id=comments>" + "<article class=comment><p>Nice, really nice, I like all of this, very, very much.</p></article>" * 9 + "</div>"
    for name in ("content no-sidebar", "layout-with-menu", "has_banner", "page share:on"):
        assert main_text(f"<body><div class='{name}'>{body}{ad}</div><footer>end</footer>") == text
        assert main_text(f"<body><div class='{name}'><article><h1>Title</h1>{body}</article>{ad}{talk}</div>") == "Title\n" + text
        assert main_text(f"<body><section id='{name}'><div class=with-nav><main>{body}{ad}</main></div></section>{talk}") == text
        assert main_text(f"<body><x-app class='{name}'><div>{body}</div>{ad}</x-app>") == text
        assert main_text(f"<body><div class='{name}'><article><p>Brief.</p></article></div>") == "Brief."
    assert main_text(f"<body><div class='post has-comments'><h1>Title</h1>{body}{talk}</div>") == "Title\n" + text
    assert main_text(f"<body><article>{body}</article>{talk}{ad}") == text
    assert main_text(f"<body><article><h1>Title</h1></article>{talk}") == "Title"
    assert main_text(f"<body>{ad}<article><h1>Title</h1><p>Brief.</article>") == "Title\nBrief."
    assert main_text(f"<body>{ad}<article><h1>Title</h1><p>Somewhat longer than brief.</article>") == "Title\nSomewhat longer than brief."


def test_main_text_that_a_form_or_an_open_menu_holds():
    """Tags that are never the article's hold it: a form around the page, a menu without end tag, what shows without scripts."""
    from millrace.llm.main_text import main_text

    p = "<p>Some words of running text, with commas, and enough of them to be a paragraph that gives points.</p>"
    plain = p[3:-4]
    for page in (
        f"<body><form id=aspnetForm><div id=content><article><h1>T</h1>{p * 2}</article></div><div class=comments>{p * 9}</div></form>",
        f"<body><form><fieldset><h1>T</h1>{p * 2}</fieldset></form><form><label>Name</label><input></form>",
        f"<body><nav><ul><li><a href=x>home</a></li></ul><article><h1>T</h1>{p * 2}</article><footer>{p}</footer>",
        f"<body><noscript><article><h1>T</h1>{p * 2}</article></noscript><noscript>Please turn scripts on</noscript>",
        f"<body><header><h2>Site</h2><p>A site for reading, and for nothing else</p></header><h1>T</h1>{p * 2}<footer>{p}</footer>",
    ):
        assert main_text(page) == f"T\n{plain}\n{plain}", page
    assert main_text(f"<body><div><h1>T</h1><p>Short.</p></div><footer>{p * 3}</footer><form>{p}</form>") == "T\nShort."


def test_main_text_with_anchors_of_sections():
    """Ids of sections and paragraphs of an article are anchors; boxes with such names, and readers' comments, are not its text."""
    from millrace.llm.main_text import main_text

    p = "<p>Some words of running text, with commas, and enough of them to be a paragraph that gives points.</p>"
    kept = f"<section id=discussion><h2>Discussion</h2>{p * 3}</section><p class=reply>What he said in reply.</p><section id=the-banner>{p}</section>"
    gone = f"<section id=comments>{p}</section><div class=discussion>{p}</div><div class=ad>buy</div><p class=advert>buy it</p><aside>{p}</aside>"
    assert main_text(f"<article><h1>T</h1>{p}{kept}{gone}</article>") == main_text(f"<article><h1>T</h1>{p}{kept}</article>")
    assert main_text(f"<article><h1>T</h1>{p}{kept}</article>").count("\n") == 7


def test_pages_against_a_plain_reading(spark):
    """Pages whose article is one element: a reading of that element alone gives the same."""
    import os
    from html.parser import HTMLParser

    from millrace.llm.main_text import extract_main_text

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            if tag == "br":
                self.blocks[-1] += " "
            elif tag in ("article", "p", "h1", "h2", "h3", "ul", "ol", "li", "div", "blockquote", "pre"):
                self.blocks.append("")

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            if tag in ("article", "p", "h1", "h2", "h3", "ul", "ol", "li", "div", "blockquote", "pre"):
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside:
                self.blocks[-1] += data

    pages = spark.read.parquet(f"{os.environ.get('TEST_SF_DIR', '/root/testdata/sf0.01')}/pages.parquet")
    expected = {}
    for r in pages.collect():
        reader = Article()
        reader.feed(r.html or "")
        reader.close()
        expected[r.page_id] = "\n".join(x for b in reader.blocks if (x := " ".join(b.split())))
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert got == expected and len(got) >= 40


def test_pages(spark):
    from millrace.llm.main_text import extract_main_text

    df = spark.createDataFrame([(1, "u", "<p>a &lt; b", 1), (2, None, None, 1), (None, "u", "", 1), (1, "u", "<p>a &lt; b", 1)], "page_id long, url string, html string, text int")
    same(extract_main_text(df).collect(), [(1, "u", "a < b", 5), (2, None, "", 0), (None, "u", "", 0), (1, "u", "a < b", 5)])


def test_empty_tables(spark, nothing):
    from millrace.llm import block_join, context_tree, edit_matching, main_text, packing, prefix_tree_join, queries, substring_dedup, suffix_dedup, token_counts, toxicity

    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    empty = [
        suffix_dedup.suffix_array_dedup(nothing),
        context_tree.score_texts(nothing, F.lit(False)),
        block_join.nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)),
        packing.best_fit_packing(nothing, queries.vocabulary("word_bpe_49k.json")),
        prefix_tree_join.prefix_tree_join(nothing),
        substring_dedup.substring_dedup(nothing),
        token_counts.token_counts(nothing, {b"a"}, set()),
        toxicity.toxicity(nothing, toxicity.train(nothing, labels)),
        main_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")),
        edit_matching.contaminated(nothing, bench),
    ]
    for df in empty:
        assert df.count() == 0


def test_suffix_arrays():
    import numpy as np

    from millrace.llm.grouping import suffix_array, suffix_arrays

    rng = np.random.default_rng(1)
    for k in range(300):
        sizes = rng.integers(1, 30, 5)
        bounds = np.r_[0, np.cumsum(sizes)]
        text = rng.integers(0, 1 + k % 4, bounds[-1])
        text[bounds[1:] - 1] = 0
        got = suffix_arrays(text, bounds)
        for a, z in zip(bounds[:-1], bounds[1:]):
            plain = sorted(range(z - a), key=lambda i: tuple(text[a + i : z]))
            assert (got[a:z] - a).tolist() == plain == suffix_array(text[a:z]).tolist()


def test_fm_index():
    import numpy as np

    from millrace.llm.fm_index import FMIndex

    rng = np.random.default_rng(2)
    for _ in range(40):
        text, stream = rng.integers(1, 4, 60), rng.integers(1, 5, 30)
        length, low, high = FMIndex(text, 8).matching_statistics(stream, np.array([0, 13, 30]))
        for a, z in ((0, 13), (13, 30)):
            for k in range(a, z):
                best = 0
                while best < min(8, z - k) and any((text[i : i + best + 1] == stream[k : k + best + 1]).all() for i in range(60 - best)):
                    best += 1
                assert length[k] == best
                if best:
                    assert high[k] - low[k] == sum((text[i : i + best] == stream[k : k + best]).all() for i in range(60 - best + 1))
