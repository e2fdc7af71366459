"""Every query of the core runs, and equals its SQL, at the smallest scale."""

import math
import os

import duckdb
import pytest

from millrace.plans import engine, ingest, prepared

QUERIES = {**ingest.QUERIES, **engine.QUERIES, **prepared.QUERIES}
ORACLES = {**ingest.ORACLES, **engine.ORACLES, **prepared.ORACLES}


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return round(float(v), 9)
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name in ORACLES:
        rel = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert rows(df.columns, got) == rows(rel.columns, rel.fetchall())
    assert set(ORACLES) <= set(QUERIES)


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = QUERIES["upsert_insert_only"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_small_upserts_do_not_shuffle_the_base(spark):
    from millrace.operators.upsert import merge

    base = spark.range(1000).selectExpr("id", "id as v")
    batch = spark.range(5).selectExpr("id", "id + 1 as v")
    plan = merge(base, batch, ["id"], small=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
