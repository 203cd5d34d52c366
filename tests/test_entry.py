import importlib
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def values(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 9) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(importlib.import_module("partsloom.plans.registry").QUERIES))
def test_query_matches_its_sql(spark, name):
    import duckdb

    df = entry.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert values(got, df.columns) == values(cur.fetchall(), columns)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["pdf_id", "figure_path"]


def test_core_does_not_need_the_text_operators():
    code = "import sys; sys.modules['partsloom.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p6_ids' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
