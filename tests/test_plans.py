"""Scans read only the columns they need, and filters reach the files."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


def scans(df):
    """(file, columns read, pushed filters) of every scan in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            name = re.search(r"/(\w+)\.parquet", line).group(1)
            columns = re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            found.append((name, {c.split("#")[0] for c in columns.split(",") if c}, pushed.group(1) if pushed else ""))
    return found


@pytest.mark.parametrize(
    ("name", "table", "columns"),
    [
        ("a02_concat_group", "lineitem", {"l_partkey", "l_returnflag"}),
        ("a04_distinct", "documents", {"lang", "source"}),
        ("d04_hierarchy_dim", "part", {"p_brand", "p_type", "p_size"}),
        ("d22_blank_urls", "pages", {"page_id", "url"}),
        ("j07_link_star", "supplier", {"s_suppkey", "s_name"}),
    ],
)
def test_columns_are_pruned(spark, name, table, columns):
    read = [c for t, c, _ in scans(driver.queries()[name](spark, SF_DIR)) if t == table]
    assert read and all(c == columns for c in read)


@pytest.mark.parametrize(
    ("name", "table", "condition"),
    [
        ("p07_semi_filter", "orders", "EqualTo(o_orderstatus,P)"),
        ("j10_semi", "lineitem", "GreaterThanOrEqual(l_quantity,48.0)"),
        ("d08_reference_lists", "lineitem", "EqualTo(l_returnflag,R)"),
        ("s12_sync_changes", "orders", "EqualTo(o_orderpriority,1-URGENT)"),
    ],
)
def test_filters_are_pushed(spark, name, table, condition):
    pushed = [p for t, _, p in scans(driver.queries()[name](spark, SF_DIR)) if t == table]
    assert any(condition in p for p in pushed)


@pytest.mark.parametrize("name", ["d01_eav_build", "d11_wide_product", "s14_typed_publish"])
def test_details_are_counted_not_gathered(spark, name):
    """No set of whole details: the attribute store gathers counted texts only."""
    plan = driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set(struct(" not in plan and "collect_set(named_struct(" not in plan
    assert "collect_list(struct(brand" in plan or "collect_list(named_struct(brand" in plan
