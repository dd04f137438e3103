"""Rows of any fields: nulls, fields that are not there, and patches of graphs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import graphs as G
from millrace.sources import variants as VT


def test_lines_of_any_fields(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"image_path": null, "imagepath": "p", "n": 1}\n\n  \n{"path": "q", "sample_id": " s "}\n')
    (tmp_path / "b.jsonl").write_text('{"image_path": "r", "n": "x", "it\'s": {"deep": [true]}}\n')
    rows = VT.read_variants(spark, [f"{tmp_path}/a.jsonl", f"{tmp_path}/b.jsonl"])
    assert sorted(r._file for r in rows.collect()) == [0, 0, 1]
    numbered = rows.withColumn("pos", F.when(VT.has(F.col("v"), "n") & (F.col("_file") == 0), 0).when(F.col("_file") == 0, 1).otherwise(2))
    strict = {(r.sample_id, r.image_path) for r in VT.filter_rows(numbered, "pos").collect()}
    assert strict == {("row_0000000", "p"), ("s", "q"), ("row_0000002", "r")}
    loose = {(r.sample_id, r.image_path) for r in VT.filter_rows(numbered, "pos", VT.NONE).collect()}
    assert loose == {("row_0000000", "None"), ("s", "q"), ("row_0000002", "r")}
    assert rows.where(F.variant_get(VT.field(F.col("v"), "it's"), "$.deep[0]", "boolean")).count() == 1
    schema = VT.merged_schema(rows)
    assert schema.startswith("OBJECT") and "n: VARIANT" in schema and "path: STRING" in schema
    (tmp_path / "c.jsonl").write_text("[1]\n")
    with pytest.raises(Exception, match="no object"):
        VT.read_variants(spark, [f"{tmp_path}/c.jsonl"]).collect()
    (tmp_path / "d.jsonl").write_text("{broken\n")
    with pytest.raises(Exception):
        VT.read_variants(spark, [f"{tmp_path}/d.jsonl"]).collect()
    with pytest.raises(Exception, match="no image path"):
        VT.filter_rows(spark.sql("select parse_json('{\"image_path\": null}') as v, 0 as pos"), "pos").collect()


def test_graphs_are_patched_without_python(spark):
    """Inputs keep their types; nodes and inputs that are not there are made; nothing else changes; no Python runs in tasks."""
    graph = {"3": {"class_type": "K", "inputs": {"seed": 1, "text": "5", "x": None, "f": 1.5, "from": ["4", 0]}, "meta": {"t": True}}, "b": {"class_type": "L", "inputs": {}}}
    df = spark.createDataFrame([(json.dumps(graph), 7, "é \"q\""), (None, 1, "x"), ("{}", 2, None)], "g string, seed long, text string")
    made = G.with_inputs(F.col("g"), {("3", "seed"): F.col("seed"), ("3", "text"): F.col("text"), ("new", "on"): F.lit(True), ("", "gone"): F.lit(1)})
    plan = df.select(made.alias("m"))
    got = [None if r.m is None else json.loads(r.m) for r in plan.collect()]
    first = json.loads(json.dumps(graph))
    first["3"]["inputs"] |= {"seed": 7, "text": "é \"q\""}
    first["new"] = {"inputs": {"on": True}}
    assert got == [first, None, {"3": {"inputs": {"seed": 2, "text": None}}, "new": {"inputs": {"on": True}}}]
    assert "Python" not in plan._jdf.queryExecution().toString()
