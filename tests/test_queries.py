"""Every registered query against its SQL in DuckDB, and the shape of the plans."""

import math

import duckdb
import pytest

import __spark_entry__
from starloom.plans.catalogue import ALL
from starloom.plans.testdata import table

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: run for name, run in __spark_entry__.queries().items() if name in ALL}
SQL = {name: sql for name, sql in __spark_entry__.oracle_sql().items() if name in ALL}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert slow not in plan
    columns = sorted(df.columns)
    got = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    if name in NO_SQL:
        assert got
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()]
    assert expected
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["category", "total"]


def test_flagship_reads_two_columns_per_table(spark):
    plan = plan_of(QUERIES["ana_count_by_category"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_partkey)]" in plan
    # Counted per part before anything is joined.
    assert plan.index("partial_sum") < plan.index("Join") < plan.index("partial_count")


def test_fact_build_has_no_shuffle(spark):
    assert "Exchange" not in plan_of(QUERIES["fct_observations"](spark, FOLDER))


def test_large_dimensions_are_not_broadcast(spark):
    """Without a size that allows it, the reports sort and merge one row per key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["ana_top_indicators"](spark, FOLDER))
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stated_types_are_those_of_the_files(spark):
    from starloom.plans.testdata import TABLES as STATED

    for name in STATED:
        assert table(spark, FOLDER, name).dtypes == spark.read.parquet(f"{FOLDER}/{name}.parquet").dtypes
