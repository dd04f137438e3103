"""The base score alone learns no tree."""

from pyspark.sql import functions as F


def test_base_scores_learn_no_tree(spark, monkeypatch):
    from millrace.llm import context_tree as T

    docs = spark.createDataFrame([(k, f"a b{k % 5} c{k} " * 3) for k in range(40)] + [(40, None)], "doc_id long, text string")
    held_out = F.col("doc_id") % 7 == 2
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)]
    whole = sorted(map(tuple, T.score_texts(docs, held_out).select(*names).collect()))
    monkeypatch.setattr(T, "learned", None)
    alone = T.score_texts(docs, held_out, model=False)
    assert sorted(map(tuple, alone.select(*names).collect())) == whole
    assert alone.where("score is not null or bits_per_byte is not null").isEmpty()
