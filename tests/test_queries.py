"""Every registered query against its SQL oracle, and the shape of its plan."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as driver
from skuloom.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "SinglePartition",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def without_summaries(plan: str) -> str:
    """The plan without the exchanges that merge the summaries of heavy keys: 32 rows at most."""
    lines = plan.splitlines()
    merged = [a for a, b in zip(lines, lines[1:]) if "SinglePartition" in a and "collect_list(_resumo" in b]
    return "\n".join(a for a in lines if a not in merged)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert len(set(df.columns)) == len(df.columns)
    plan = without_summaries(plan_of(df))
    assert not [word for word in FORBIDDEN if word in plan]
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare.differences(df, con, sql) is None


def test_oracles_belong_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    rows = df.collect()
    assert {r.preenchido for r in rows} == {"Sim", "Não"}
    assert sum(r.contagem for r in rows) == rows[0].total
