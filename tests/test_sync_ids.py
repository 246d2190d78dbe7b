from __future__ import annotations

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from skuloom.operators import ids, sync
from skuloom.plans.inputs import load_time

NOW = datetime.datetime(2024, 1, 1)
OLD = datetime.datetime(2020, 1, 1)


def test_upsert_all(make):
    schema = "s string, t string, k string, flag string, v string"
    target = make([("a", "t", "1", "on", "x"), ("a", "t", "2", "on", "y"), ("a", None, "3", "on", "null key")], schema)
    updates = make([("a", "t", "1", "off", None), ("a", "t", "9", "off", "new"), ("a", "t", "9", "off", "new"),
                    ("a", None, "3", "off", "other")], schema)
    keys = ["s", "t", "k"]
    got = sorted(sync.upsert_all(target, updates, keys).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", "t", "1", "off", None), ("a", "t", "2", "on", "y"), ("a", "t", "9", "off", "new"),
        ("a", None, "3", "on", "null key"), ("a", None, "3", "off", "other"),
    ], key=str)
    kept = {r.k: r.flag for r in sync.upsert_all(target, updates, keys, keep=("flag",)).where("t is not null").collect()}
    assert kept == {"1": "on", "2": "on", "9": "off"}


def test_update_shop_urls(make):
    products = make([("A1 ", "old"), ("b", "old"), ("c", None)], "sku string, url string")
    shop = make([(" a1_PAI", "u1"), ("A1", "u2"), ("B", None), ("zz", "u3")], "ProductRefId string, DetailUrl string")
    got = {r.sku: r.url for r in sync.update_shop_urls(products, shop, "_PAI", "url").collect()}
    assert got == {"A1 ": "u2", "b": "old", "c": None}


def stage_and_target(make):
    stage = make([("same", "1"), ("new", None), ("changed", "2"), ("nulled", None)], "sku string, v string")
    target = make([("same", "1", OLD, None), ("changed", "1", OLD, None), ("nulled", "x", OLD, OLD), ("gone", "z", OLD, None)],
                  "sku string, v string, created_at timestamp, updated_at timestamp")
    return stage, target


def test_sync_changes_and_apply(make):
    stage, target = stage_and_target(make)
    changes = sync.sync_changes(target, stage, ["sku"], load_time())
    assert {tuple(r) for r in changes.collect()} == {
        ("=", "same", "1", OLD, None), ("I", "new", None, NOW, None), ("U", "changed", "2", OLD, NOW),
        ("U", "nulled", None, OLD, NOW), ("D", "gone", "z", OLD, None),
    }
    applied = sync.sync_apply(changes)
    assert {tuple(r) for r in applied.select("sku", "v").collect()} == {tuple(r) for r in stage.collect()}


def test_sync_is_idempotent(make):
    stage, target = stage_and_target(make)
    applied = sync.sync_apply(sync.sync_changes(target, stage, ["sku"], load_time()))
    again = sync.sync_changes(applied, stage, ["sku"], load_time())
    assert {r.op for r in again.collect()} == {"="}


def test_sync_by_owner(make):
    schema = "sku string, id string, v string"
    target = make([("a", "1", "old"), ("a", "2", "old"), ("gone", "1", "old")], schema)
    stage = make([("a", "1", "new"), ("a", "3", "not inserted: owner known"), ("b", "1", "ins"), ("b", "1", "ins")], schema)
    got = sorted(map(tuple, sync.sync_by_owner(target, stage, "sku", ["sku", "id"]).collect()))
    assert got == [("=", "a", "2", "old"), ("D", "gone", "1", "old"), ("I", "b", "1", "ins"), ("U", "a", "1", "new")]


def test_link_rebuild(make):
    images = make([("a", "i1", "f"), ("a", "i2", None), ("a", "i3", "f"), ("a", "i3", "f"), ("x", "i4", "f")],
                  "sku string, id string, nome_arquivo string")
    products = make([("a", "p1"), ("b", "p2")], "sku string, id string")
    links = make([("i1", "p1")], "produto_imagem_id string, produto_id string")
    assert [tuple(r) for r in sync.link_rebuild(images, products, links).collect()] == [("i3", "p1")]


def test_surrogate_id_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("g"), (F.col("id") % 2500).alias("x"))
    rows = ids.surrogate_id(df, ["g"]).collect()
    expected = sorted((str(i % 7), i % 2500) for i in range(5000))
    assert [(r.g, r.x) for r in sorted(rows, key=lambda r: r.id)] == expected
    assert sorted(r.id for r in rows) == list(range(1, len(expected) + 1))


def test_surrogate_id_spreads_one_hot_key(spark):
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ids.surrogate_id(df, ["g"])
        sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()[:] == (1, 20000, 20000)
    assert len(sizes) > 4 and max(sizes) < 20000 / 2


def test_surrogate_id_of_nothing(spark):
    assert ids.surrogate_id(spark.range(0).select(F.col("id").alias("x")), ["x"]).count() == 0


def test_hash_id(make):
    df = make([("1",), ("2",), ("1",)], "sku string")
    hashed = ids.hash_id(df, ["sku"])
    assert hashed.select("id").distinct().count() == 2
    assert ids.id_collisions(hashed, ["sku"]).count() == 0
    clash = hashed.withColumn("id", F.lit(1))
    assert ids.id_collisions(clash, ["sku"]).first()["count"] == 2


def test_increment_keeps_old_ids_and_numbers_new_keys(make):
    existing = make([("a", 1), ("b", 2), (None, 3), ("gone", 7)], "k string, id long")
    rows = make([("b", "x"), ("c", "y"), (None, "z"), ("a", "v"), ("0", "w"), ("c", "y")], "k string, v string")
    got = sorted(map(tuple, ids.surrogate_increment(existing, rows, ["k"], ["k"]).collect()), key=str)
    assert got == sorted([("b", "x", 2), ("c", "y", 9), ("c", "y", 9), (None, "z", 3), ("a", "v", 1), ("0", "w", 8)], key=str)
    first = ids.surrogate_increment(existing.where("false"), rows, ["k"], ["k"])
    assert sorted({(r.k, r.id) for r in first.collect()}, key=lambda x: x[1]) == [(None, 1), ("0", 2), ("a", 3), ("b", 4), ("c", 5)]
    assert ids.surrogate_increment(existing, rows.where("false"), ["k"], ["k"]).count() == 0


def digest_id(key: str | None, attempt: int, bits: int) -> int:
    text = "-" if key is None else f"{len(key)}:{key}"
    text += f"#{attempt}" if attempt else ""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) >> (60 - bits)


def test_collisions_are_resolved_by_probing(make):
    keys = [None, "", *[f"k{i}é" for i in range(50)]]
    waiting, settled = {k: 0 for k in keys}, {}
    while waiting:
        tried: dict[int, list] = {}
        for k, attempt in waiting.items():
            tried.setdefault(digest_id(k, attempt, 8), []).append(k)
        won = {i: min(ks, key=lambda k: (k is not None, k or "")) for i, ks in tried.items() if i not in settled.values()}
        settled |= {k: i for i, k in won.items()}
        waiting = {k: n + 1 for k, n in waiting.items() if k not in settled}
    got = ids.resolved_id(make([(k, n) for k in keys for n in (1, 2)], "k string, n int"), ["k"], bits=8).collect()
    assert len(got) == 2 * len(keys) and {(r.k, r.id) for r in got} == set(settled.items())
    assert len(set(settled.values())) == len(keys)
    full = ids.resolved_id(make([(k,) for k in keys], "k string"), ["k"])
    assert {(r.k, r.id) for r in full.collect()} == {(k, digest_id(k, 0, 60)) for k in keys}
    with pytest.raises(ValueError, match="2 bits"):
        ids.resolved_id(make([(k,) for k in keys[:6]], "k string"), ["k"], bits=2)


def test_columns_of_an_id_do_not_run_together(make):
    rows = make([("a", "bc"), ("ab", "c"), ("abc", None), (None, "abc"), ("1:a", ""), ("1", ":a")], "x string, y string")
    assert ids.hash_id(rows, ["x", "y"]).select("id").distinct().count() == 6
