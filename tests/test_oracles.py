"""Every query that has SQL gives the rows that DuckDB gives."""

import os

import pytest

from millrace.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def compare(spark, name, query, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    expected = sorted(tuple(plain(v) for _, v in sorted(zip(names, r))) for r in cur.fetchall())
    df = query(spark, SF)
    got = sorted(tuple(plain(v) for _, v in sorted(zip(df.columns, r))) for r in df.collect())
    assert sorted(df.columns) == sorted(names)
    assert got == expected


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    compare(spark, name, QUERIES[name], ORACLES[name])
