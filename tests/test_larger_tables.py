"""Queries over tables with keys and an order of rows that the small tables don't have."""

import os

import pytest

from millrace import queries as Q

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    """A folder for changed tables, and a function that compares a query over them with its SQL."""
    import duckdb

    from test_oracles import plain

    con = duckdb.connect()

    def made(name, sql):
        con.execute(f"copy ({sql.replace('{old}', SMALL)}) to '{tmp_path}/{name}.parquet'")
        con.execute(f"create or replace view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")

    def same(name):
        cur = con.execute(Q.ORACLES[name])
        names = [c[0] for c in cur.description]
        expected = sorted(tuple(plain(v) for v in r) for r in cur.fetchall())
        got = Q.QUERIES[name](spark, str(tmp_path)).select(*names).collect()
        assert sorted(tuple(plain(v) for v in r) for r in got) == expected and expected

    return made, same


def test_names_that_occur_again_are_files_of_their_own(tables):
    """Keys of six digits are cut to five in the names, so that names occur again and counters don't tell the order."""
    made, same = tables
    made("customer", "select * replace (c_custkey + i * 99990 as c_custkey) from '{old}/customer.parquet', range(3) r(i)")
    made("orders", "select * replace (o_orderkey + i * 10000 as o_orderkey, o_custkey + i * 99990 as o_custkey) from '{old}/orders.parquet', range(3) r(i)")
    same("clean_manifest")
    same("clean_summary")


def test_a_log_of_several_copies_loses_no_event(tables):
    """Each copy of the log begins anew, later than the watermark allows."""
    made, same = tables
    made("events", "select * replace (event_id + i * 100000 as event_id, user_id + i * 1000 as user_id) from '{old}/events.parquet', range(7) r(i) order by i, event_id")
    same("job_transitions")
    same("streamed_events")


def test_a_longer_log_has_no_more_batches(spark, tmp_path):
    from millrace.sources.events import stream_of
    from millrace.streaming import replay

    spark.range(900).write.parquet(str(tmp_path / "log"))
    stream = stream_of(spark, str(tmp_path / "log"), spark.range(1).schema, str(tmp_path / "mark"), rows=10, batches=4)
    got = replay(stream, paced=True, folder=str(tmp_path / "replay"))
    assert sorted(r.id for r in got.collect()) == list(range(900))
    assert len(list((tmp_path / "replay" / "rows").iterdir())) == 4


def test_texts_are_read_again_by_batches(spark):
    """By one step of whole Arrow batches, not by expressions that are interpreted for each letter."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from millrace.functions import templates as T

    df = spark.createDataFrame([("x'y", "{a!r:>7}{{"), ("\u00adz", "{a!a}"), ("q", "none")], "a string, b string").repartition(1)
    made = df.select(T.render("$b|{a:^5}", {c: F.col(c) for c in "ab"}).alias("t"))
    assert sorted(r.t for r in made.collect()) == sorted(['  "x\'y"{| x\'y ', "'\\xadz'| \u00adz  ", "none|  q  "])
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        made.explain()
    assert "ArrowEvalPython" in plan.getvalue()


def test_label_lines_are_made_by_batches(spark):
    """By one step of whole Arrow batches, with missing numbers, ties of the sixth place and visibilities of more than one character."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from millrace.functions import vision as V

    rows = [(1, [0.0, 20.0, 10.0, 20.0], [1.0, 2.0, 2.0, None, 3.0, 12.0], 128), (2, [0.0, None, 1.0, 1.0], [], 128), (3, [0.0, 1.0, 1.0, 1.0], [], None)]
    df = spark.createDataFrame(rows, "k int, b array<double>, p array<double>, w int").repartition(1)
    made = df.select("k", V.coco_label_line(F.col("b"), F.col("p"), F.col("w"), F.lit(200)).alias("t"))
    line = "0 0.039062 0.150000 0.078125 0.100000 0.007812 0.010000 2 0.000000 0.015000 12" + " 0.000000 0.000000 0" * 15
    assert {r.k: r.t for r in made.collect()} == {1: line, 2: None, 3: None}
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        made.explain()
    assert "ArrowEvalPython" in plan.getvalue()


def test_partitions_of_a_subset_follow_its_rows(spark, monkeypatch):
    from millrace.operators import relational as R

    monkeypatch.setattr(R, "TASK_ROWS", 100, raising=False)
    lines = spark.range(3000).selectExpr("id % 1000 as k", "id")
    images = spark.range(1000).selectExpr("id as k", "id % 5 as license")
    kept, annotations, licences = R.subset(images.where("k < 500").select("k"), "k", images, lines, spark.range(5))
    assert annotations.rdd.getNumPartitions() == 30
    assert (kept.count(), annotations.count(), licences.count()) == (500, 1500, 5)
