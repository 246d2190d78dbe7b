"""Commits of several tables, slices that come and go, and merges that leave other files alone."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skuloom.operators import eav, merge
from skuloom.plans.inputs import load_time
from skuloom.sources import snapshots


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path / "tables")


def rows(spark, root, table):
    return Counter(map(tuple, snapshots.read_snapshot(spark, root, table).collect()))


def test_slices_replace_each_other_and_empty_ones_go(spark, make, root):
    schema = "origem string, v int"
    first = make([("a", 1), ("b/=%", 2), (None, 3), ("", 4), ("nulo", 5)], schema)
    assert snapshots.publish_slices(spark, root, {"t": first}) == ["t"]
    snapshots.publish_slices(spark, root, {"t": make([("b/=%", 7), ("b/=%", 8)], schema)})
    assert rows(spark, root, "t") == Counter([("a", 1), ("b/=%", 7), ("b/=%", 8), (None, 3), ("", 4), ("nulo", 5)])
    snapshots.publish_slices(spark, root, {"t": make([("a", 9)], schema)}, slices=["a", None, "b/=%", "never"])
    assert rows(spark, root, "t") == Counter([("a", 9), ("", 4), ("nulo", 5)])
    snapshots.publish_slices(spark, root, {"t": make([], schema)}, slices=["a", "", "nulo"])
    assert rows(spark, root, "t") == Counter()


def test_new_columns_and_changed_types(spark, make, root):
    snapshots.publish_slices(spark, root, {"t": make([("a", 1)], "origem string, v int")})
    snapshots.publish_slices(spark, root, {"t": make([("b", "x")], "origem string, w string")})
    assert rows(spark, root, "t") == Counter([("a", 1, None), ("b", None, "x")])
    with pytest.raises(ValueError, match="column v"):
        snapshots.publish_slices(spark, root, {"t": make([("b", "x")], "origem string, v string")})


def test_a_failing_table_changes_none(spark, make, root):
    schema = "origem string, v string"
    snapshots.publish_slices(spark, root, {"x": make([("a", "1")], schema), "y": make([("a", "1")], schema)})
    before = snapshots.current(spark, root)
    bad = make([("a", "2")], schema).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        snapshots.publish_slices(spark, root, {"x": make([("a", "2")], schema), "y": bad})
    assert snapshots.current(spark, root) == before
    assert rows(spark, root, "x") == rows(spark, root, "y") == Counter([("a", "1")])


def test_of_two_commits_from_one_base_the_second_fails(spark, make, root):
    snapshots.publish_slices(spark, root, {"t": make([("a", 1)], "origem string, v int")})
    base = snapshots.current(spark, root)
    snapshots.commit(spark, root, base, {})
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit(spark, root, base, {})
    assert snapshots.current(spark, root).version == base.version + 1
    assert not [f for f in Path(root).glob(".manifest-*") if f.suffix != ".crc"]


def test_publish_families(spark, make, root):
    wide = make([("1", "x", 2, 1.5), ("2", None, None, 2.5)], "k string, s string, n int, f double")
    assert eav.publish_families(wide, "k", "erp", load_time(), root) == ["atributo_bigint", "atributo_float", "atributo_string"]
    eav.publish_families(make([("9", "y")], "k string, s string"), "k", "other", load_time(), root)
    assert eav.publish_families(wide.drop("f", "s"), "k", "erp", load_time(), root) == ["atributo_bigint"]
    cells = {t: {(r.origem, r.sku, r.valor) for r in snapshots.read_snapshot(spark, root, t).collect()}
             for t in ("atributo_bigint", "atributo_float", "atributo_string")}
    assert cells == {"atributo_bigint": {("erp", "1", 2), ("erp", "2", None)}, "atributo_float": set(),
                     "atributo_string": {("other", "9", "y")}}


def parts_of(spark, root, table):
    return snapshots.current(spark, root).tables[table].parts


def files(folder: str) -> set[tuple[str, int]]:
    return {(f.name, f.stat().st_mtime_ns) for f in Path(folder).glob("*.parquet")}


def test_merge_rewrites_touched_buckets_only(spark, make, root):
    schema = "k string, v string, flag string"
    target = [(f"k{i}", "old", "on") for i in range(500)] + [(None, "keyless", "on")] * 3
    merge.create_buckets(make(target, schema), root, "t", ["k"], buckets=32)
    before = parts_of(spark, root, "t")
    kept = {p: files(f) for p, f in before.items()}
    updates = [("k7", "new", "off"), ("k7", "newer", "off"), ("fresh", "new", "off")]
    merge.merge_buckets(spark, root, "t", make(updates, schema), keep=("flag",))
    after = parts_of(spark, root, "t")
    changed = {p for p in after if after[p] != before.get(p)}
    assert 1 <= len(changed) <= 2
    assert all(files(after[p]) == kept[p] for p in after.keys() - changed)
    want = Counter(("k7", "newer", "on") if r[0] == "k7" else r for r in target) + Counter([("fresh", "new", "off")])
    assert rows(spark, root, "t") == want
    merge.merge_buckets(spark, root, "t", make([(None, "more", "on")], schema))
    assert rows(spark, root, "t") == want + Counter([(None, "more", "on")])
    version = snapshots.current(spark, root).version
    assert merge.merge_buckets(spark, root, "t", make([], schema)).version == version


def test_update_leaves_buckets_without_a_match(spark, make, root):
    merge.create_buckets(make([(f"A{i} ", None) for i in range(200)], "k string, url string"), root, "t", ["k"], buckets=16)
    before = parts_of(spark, root, "t")
    source = make([(" a3", "u1"), ("a3", "u2"), ("a4", None), *[(f"zz{i}", "u") for i in range(50)]], "r string, url string")
    merge.update_buckets(spark, root, "t", source, "r", "url")
    after = parts_of(spark, root, "t")
    assert sum(after[p] != before[p] for p in after) == 1
    assert rows(spark, root, "t") == Counter((f"A{i} ", "u2" if i == 3 else None) for i in range(200))
    version = snapshots.current(spark, root).version
    nothing = make([("zz", "u")], "r string, url string")
    assert merge.update_buckets(spark, root, "t", nothing, "r", "url").version == version
