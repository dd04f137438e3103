"""Each stage of the pipeline does what its operator decides, judged on the stage's own input."""

import collections

import corpus_pipeline as P
from millrace.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    inputs = [start]
    for _, stage in P.STAGES:
        inputs.append(stored(stage(spark, inputs[-1], SF)))
    rows = [[r.asDict() for r in d.collect()] for d in inputs]
    for d in inputs[1:-1]:
        assert d.columns == start.columns
    by = [{r["doc_id"]: r for r in x} for x in rows[:-1]]
    for before, after in zip(by[:2], by[1:3]):  # filters keep rows as they are
        assert all(before[i] == r for i, r in after.items())

    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())

    sets = {i: shingles(r["text"]) for i, r in by[1].items()}
    near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    links = collections.defaultdict(set)
    for a in sets:
        for b in sets:
            if a != b and near(a, b):
                links[a].add(b)
    stays = set()
    for i in sorted(sets):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        if min(seen) == i:
            stays.add(i)
    assert set(by[2]) == stays

    texts = {i: (r["text"] or "").encode() for i, r in by[2].items()}
    count = collections.Counter(t[k : k + 200] for t in texts.values() for k in range(len(t) - 199))
    for i, t in texts.items():
        gone = bytearray(len(t))
        for k in range(len(t) - 199):
            if count[t[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone) if not g).decode(errors="ignore") if any(gone) else by[2][i]["text"]
        assert by[3][i]["text"] == kept and by[3][i]["n_chars"] == len(kept)

    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda t: any(x in " ".join((t or "").lower().split()) for x in items)
    assert not any(holds(r["text"]) for r in rows[4])
    assert {i for i, r in by[3].items() if not holds(r["text"])} == set(by[4])
    assert {r["doc_id"] for r in rows[5]} == set(by[4])


def test_nulls_repeats_and_nothing(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = " ".join(f"word{k % 37}x{k % 11}" for k in range(90))
    docs = spark.createDataFrame([(1, text, "en", "s", 3), (1, text, "en", "s", 3), (2, text, None, None, None), (None, text + " end", "en", "s", 3), (None, None, None, None, None), (3, "", "en", "s", 0), (4, None, "en", "s", None)], schema)
    one = P.one_of_near_copies(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text or "") for r in one.collect()) == [(0, ""), (1, text), (3, ""), (4, "")]
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() > 0
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_row_of_each_group(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    a, b, c = (" ".join(f"{w}{k % 37}x{k % 11}" for k in range(90)) for w in ("red", "green", "blue"))
    texts = [(None, a), (None, a + " end"), (None, a), (5, b), (5, b + " end"), (5, b), (9, b + " tail"), (None, c), (4, c + " end"), (6, "alone"), (None, "single")]
    texts += [(None, None), (None, ""), (None, None), (7, " \t\n"), (7, " \t\n"), (None, "\u00a0")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in texts], schema)
    got = [(r.doc_id, r.text) for r in P.one_of_near_copies(spark, docs, SF).collect()]
    count = collections.Counter(got)
    assert sum(n for (_, t), n in count.items() if t and t.startswith("red")) == 1
    assert [(i, n) for (i, t), n in count.items() if t and t.startswith("green")] == [(5, 1)]
    assert [(i, n) for (i, t), n in count.items() if t and t.startswith("blue")] == [(4, 1)]
    rest = {x: n for x, n in count.items() if not (x[1] or "").startswith(("red", "green", "blue"))}
    assert rest == {(6, "alone"): 1, (None, "single"): 1, (None, None): 2, (None, ""): 1, (7, " \t\n"): 2, (None, "\u00a0"): 1}
