from __future__ import annotations

import pytest

from skuloom.operators import pivots


@pytest.mark.parametrize("limit", [64, 0])
def test_both_pivot_forms_agree(make, monkeypatch, limit):
    monkeypatch.setattr(pivots, "MAX_CONDITIONAL", limit)
    rows = [("k", "a", "x", None), ("k", "a", "y", None), ("k", "b", None, 9), ("k", "b", None, 10),
            ("k", "z", "ignored", None), ("m", None, None, None), (None, "a", "n", None)]
    df = make(rows, "k string, n string, t string, i bigint")
    got = pivots.pivot_max(df, ["k"], "n", ["a", "b.c", "b"], ["t", "i"])
    assert got.columns == ["k", "a", "b.c", "b"]
    assert {tuple(r) for r in got.collect()} == {
        ("k", "y", None, "10"), ("m", None, None, None), (None, "n", None, None),
    }


def test_one_value_column_keeps_its_type(make):
    df = make([("k", "a", 1), ("k", "a", 3)], "k string, n string, i int")
    assert pivots.pivot_max(df, ["k"], "n", ["a"], ["i"]).first().a == 3


def test_names_are_found(make):
    df = make([(1, "b", "x"), (1, None, "y"), (2, "a.c", "z"), (2, "b", None)], "k int, n string, v string")
    assert pivots.names_found(df, "n") == ["a.c", "b"]
    assert pivots.names_found(df.limit(0), "n") == []


def test_many_names_are_reduced_once(spark, make):
    """A key's cells lie in one hash table of a task, not in one for each time they are reduced."""
    names = [f"n{i}" for i in range(pivots.MAX_CONDITIONAL + 1)]
    df = make([("a", "n0", 1), ("a", "n0", 3), ("a", "n64", 2), ("b", None, None)], "k string, n string, v int")
    wide = pivots.pivot_max(df, ["k"], "n", names, ["v"])
    got = {r.k: {n: r[n] for n in names if r[n] is not None} for r in wide.collect()}
    assert got == {"a": {"n0": 3, "n64": 2}, "b": {}}
    plan = df._sc._jvm.PythonSQLUtils.explainString(wide._jdf.queryExecution(), "simple")
    initial = plan[plan.rfind("== Initial Plan ==") :]
    assert initial.count("HashAggregate(") == 4
