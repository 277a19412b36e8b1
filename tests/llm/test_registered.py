"""The registered text queries and the pipeline: against their SQL, on empty tables, and without pair joins."""

import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from ledgerline.llm import queries as Q

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES = [*Q.all_queries(), "pipeline"]


def test_all_are_registered_with_the_stages_in_order():
    assert set(QUERIES) <= set(E.queries()) and set(Q.all_sql()) <= set(E.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "repeated_passages", "packing"]


@pytest.mark.parametrize("name", sorted(Q.all_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(SF_SMALL, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(Q.all_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(c[0] for c in res.description)
    at = [[c[0] for c in res.description].index(c) for c in columns]
    rounded = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    want = sorted((rounded(r[i] for i in at) for r in res.fetchall()), key=repr)
    assert sorted((rounded(r) for r in df.select(*columns).collect()), key=repr) == want


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        spark.read.parquet(os.path.join(SF_SMALL, f"{t}.parquet")).limit(0).write.parquet(os.path.join(d, f"{t}.parquet"))
    return d


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_on_empty_tables(spark, empty_dir, name):
    assert E.queries()[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, empty_dir, name):
    plan = E.queries()[name](spark, empty_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
