"""Every query that has SQL, over the smallest tables, against DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows_of

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are missing")


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, SF)
    cursor = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries())))
def test_plans_have_no_cross_join_and_no_global_window(spark, physical_plan, name):
    if name in ("bpe_train_texts", "stage_three", "stage_four", "word2vec_vectors", "tokenizer_comparison", "tokenizer_comparison_texts", "stage_three_texts", "skipgram_vectors"):
        pytest.skip("builds a model before there is a plan")
    plan = physical_plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    for line in plan.splitlines():
        if "Window [" in line or "WindowGroupLimit [" in line:
            assert "], [" in line, line
