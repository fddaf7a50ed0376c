"""Every registered query of the engine against its SQL, on the small tables."""

import numbers
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from mnemon.plans import oracles, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        con.execute(f"create view {table} as select * from '{DATA}/{name}'")
    return con


def _cell(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return None
    return float(v) if isinstance(v, numbers.Number) and not isinstance(v, bool) else v


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr([_cell(v) for v in row]) for row in frame.values.tolist())


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, duck, name):
    got, want = queries.queries()[name](spark, DATA).toPandas(), duck.execute(oracles.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(oracles.ORACLES) <= set(entry.queries())


def test_project_hints(spark):
    rows = queries.project_hints(spark, DATA).collect()
    assert rows and all(0.6 <= r["confidence"] <= 1 for r in rows) and {r["rank"] for r in rows} >= {1}


def test_recall_merge_splits_once(spark):
    """Documents' texts are lowered and split in one place of the plan, not in the filter on the total as well."""
    plan = queries.recall_merge(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == plan.count("regexp_extract_all(") == 1
