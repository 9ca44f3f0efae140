"""Every query runs, those with SQL give its rows, and native ones have native plans."""

import pytest

import __spark_entry__ as entry
from millrace.plans.catalog import QUERIES
from tools import compare

PYTHON = {"fc_grouped_map", "udf_grouped_map"}


def native(df):
    plan = df._jdf.queryExecution().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "MapInPandas"):
        assert node not in plan
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in plan


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, sf_dir, key):
    assert compare.compare(spark, con, key, sf_dir, None if key in PYTHON else native) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
