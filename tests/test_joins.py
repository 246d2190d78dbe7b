"""Hot keys: a third of the rows share one key, and copies of one row are hot as well."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from skuloom.operators.joins import SPREAD, Link, heavy_keys, join_normalised, link_star, lookup_join


@pytest.fixture
def hot(spark):
    """30,000 rows, a third of them copies of one row."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    value = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(30000, numPartitions=8).select(key.alias("k"), value.alias("v"))


@pytest.fixture
def lookup(spark):
    named = spark.range(0, 500, 2).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("string").alias("n"))
    return named.unionByName(spark.range(1).select(F.lit("hot").alias("k"), F.lit("H").alias("n")))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(hot, lookup, how):
    plain = hot.join(lookup, "k", how)
    salted = lookup_join(hot, lookup, ["k"], how, salts=7)
    assert salted.columns == plain.columns
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_other_join_types_are_refused(hot, lookup):
    with pytest.raises(ValueError):
        lookup_join(hot, lookup, ["k"], "full_outer")


def shuffle_join_conf(spark, adaptive):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.fixture
def restore(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    yield
    for name, value in before.items():
        spark.conf.set(name, value)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_measured_split_equals_plain_join(spark, hot, lookup, restore, how, adaptive):
    shuffle_join_conf(spark, adaptive)
    left = hot.unionByName(spark.range(50).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v")))
    plain = left.join(lookup, "k", how)
    split = lookup_join(left, lookup, ["k"], how)
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_only_heavy_keys_get_sub_keys(spark, hot):
    marked = heavy_keys(hot, ["k"]).collect()
    (code,) = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [(r[0], r[1]) for r in marked] == [(code, -(-SPREAD * tasks // 3))]
    assert heavy_keys(hot.limit(0), ["k"]).count() == 0


def test_a_small_lookup_is_left_to_spark(spark, hot, lookup, restore):
    assert "approx_top_k" not in lookup_join(hot, lookup, ["k"])._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "approx_top_k" in lookup_join(hot, lookup, ["k"])._jdf.queryExecution().toString()


def test_join_normalised(make):
    left = make([(" Aa", 1), ("b", 2), (None, 3)], "x string, i int")
    right = make([("aA ", "p"), (None, "q")], "y string, j string")
    assert [(r.i, r.j) for r in join_normalised(left, right, "x", "y").collect()] == [(1, "p")]
    assert join_normalised(left, right, "x", "y", "left").count() == 3


def test_link_star_does_not_fan_out(make):
    owners = make([(1, "p1"), (2, "p2")], "id int, sku string")
    links = make([(1, 10), (1, 11), (1, 10), (2, 99)], "p int, c int")
    colours = make([(10, "red"), (11, "blue")], "id int, title string")
    sizes = make([(1, 7)], "p int, s int")
    sizes_of = make([(7, "XL")], "id int, title string")
    star = link_star(owners, "id", [Link("cor", links, "p", "c", colours, "id", "title"),
                                    Link("tam", sizes, "p", "s", sizes_of, "id", "title")])
    assert {tuple(r) for r in star.collect()} == {(1, "p1", "blue;red", "XL"), (2, "p2", "", "")}


def test_link_star_holds_numbers_of_fields(make):
    """The task that drops repeated links keeps no name of a field in each of its rows."""
    links, items = make([(1, 1), (1, 1), (1, 2)], "o int, i int"), make([(1, "x"), (2, "y")], "id int, title string")
    star = link_star(make([(1,), (2,)], "id int"), "id", [Link(f, links, "o", "i", items, "id", "title") for f in ("f", "g")])
    assert sorted(map(tuple, star.collect())) == [(1, "x;y", "x;y"), (2, "", "")]
    analysed = star._jdf.queryExecution().analyzed().toString()
    assert "0 AS campo" in analysed and "1 AS campo" in analysed and "f AS campo" not in analysed
