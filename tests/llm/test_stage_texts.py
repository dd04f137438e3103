"""The near copies stage sends the texts that may stay, not those of all near copies."""


def test_copies_that_go_are_not_sent(spark, monkeypatch):
    import corpus_pipeline as P

    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    texts = [" ".join(f"{chr(97 + t)}{k % 37}x{k % 11}" for k in range(90)) for t in range(8)]
    docs = spark.createDataFrame([(t + 8 * j, texts[t] + " end" * (j % 2), "en", "s", None) for j in range(10) for t in range(8)], schema).repartition(4)
    made, old = [], P.mapped

    def kept(df, mapper, *rest):
        out = old(df, mapper, *rest)
        if mapper.__name__ == "marked":
            made.append(out)
        return out

    monkeypatch.setattr(P, "mapped", kept)
    assert sorted(r.doc_id for r in P.one_of_near_copies(spark, docs, "").collect()) == list(range(8))
    assert len(made) == 1 and made[0].where("_doubt").count() == 8
