"""Counts by bitmaps against the matrix, logs of url verdicts, combinations dealt in blocks."""

from __future__ import annotations

import random
from collections import Counter
from itertools import product

from pyspark.sql import functions as F

from skuloom.operators import completeness as C
from skuloom.operators import hierarchy, publish, quality
from skuloom.sources import tables


def month(m: int):
    return F.lit(f"2024-0{m}-01").cast("timestamp")


def test_counts_by_bitmaps_equal_the_matrix(make):
    """More names than one word has bits, names that differ in case only, both rule groups."""
    rng = random.Random(1)
    names = [f"attr{i}" for i in range(300)] + ["Attr1", "ATTR2 ", "x_ref_y", "hierarquia_web"]
    nodes = [(f"n{i}", [(n, rng.choice([True, False, None])) for n in rng.sample(names, 40)]) for i in range(12)]
    nodes += [("empty", []), ("none", None)]
    paths = [(f"s{i}", (rng.sample([n for n, _ in nodes] + [None, "unknown"], rng.randrange(7)),)) for i in range(60)]
    eav = [(rng.choice([s, f" {s.upper()}"]), rng.choice([n, n.upper()]), "v") for s, _ in paths for n in rng.sample(names, 50)]
    eav += [(s, "Status_Exib_Site", rng.choice(["Sim", "nao", None])) for s, _ in paths]
    primary = make(paths, "sku string, hierarchies struct<primary: array<string>>")
    rules = make(nodes, "_id string, attributes array<struct<field: string, required: boolean>>")
    store = make(eav, "sku string, atributo string, valor string")
    for required, rule in ((None, C.on_site), (True, lambda v: v.isNotNull()), (False, C.on_site)):
        matrix = C.completeness(primary, rules, store, required, site_rule=rule)
        # null and false are two rules that show alike; counts of both are added up in either form
        want = Counter((r.sku, r.obrigatorio, r.preenchido) for r in matrix.collect())
        got = C.completeness_counts(primary, rules, store, required, site_rule=rule).collect()
        assert {(r.sku, r.obrigatorio): (r["Sim"], r["Não"]) for r in got} == {
            k: (want[(*k, "Sim")], want[(*k, "Não")]) for k in {(s, o) for s, o, _ in want}}
        assert len(got) > 5


def test_numbered_attributes_have_bits_of_their_own(make):
    rules = make([(f"a{i}",) for i in range(700)] * 2, "atributo string")
    rows = C.numbered_attributes(rules).collect()
    assert len(rows) == 700 == len({(r.palavra, r.bit) for r in rows})
    assert all(bin(r.bit).count("1") == 1 and r.bit > 0 for r in rows)


def test_url_log(spark, make, tmp_path):
    path = str(tmp_path / "log")
    schema = "url string, status int, body string"
    quality.append_url_log(make([(" a ", 200, "ok"), ("a", 404, ""), ("b", 200, "ok"), (None, 200, ""), ("c", -1, "")], schema), path, month(1))
    quality.append_url_log(make([("a", 200, "ok"), ("c", 200, quality.K.NOT_FOUND_PHRASE)], schema), path, month(2))
    log = tables.read_table(spark, path)
    assert log.count() == 5
    latest = {r.url: (r.status, r.situacao, r.data_ingestao.month) for r in quality.latest_urls(log).collect()}
    assert latest == {"a": (200, None, 2), "b": (200, None, 1), "c": (200, "pagina_inexistente", 2)}
    targets = make([("a",), ("b ",), ("b",), ("new",), (None,), (" ",)], "url string")
    assert sorted(r.url for r in quality.due_urls(targets, log, month(2)).collect()) == ["b", "new"]
    assert [r.url for r in quality.due_urls(targets, log, month(1)).collect()] == ["new"]
    compact = tables.read_table(spark, quality.compact_urls(log, str(tmp_path / "compact")))
    assert {r.url: (r.status, r.situacao, r.data_ingestao.month) for r in compact.collect()} == latest


def test_combinations_are_those_of_explode_outer(make):
    rows = [("a", [1, 2, 3], ["x", "y"], [True]), ("b", [], None, [True, False]), ("c", [4], ["z"], []),
            ("d", list(range(7)), list("abcde"), [True, False, None])]
    df = make(rows, "k string, p array<int>, q array<string>, r array<boolean>")
    got = Counter(map(tuple, hierarchy.combinations(df, ["p", "q", "r"], block=4).collect()))
    assert got == Counter((k, *c) for k, *lists in rows for c in product(*[x or [None] for x in lists]))


def test_one_product_with_many_nodes_is_spread_over_tasks(spark):
    ids = lambda n: F.sequence(F.lit(1), F.lit(n))
    df = spark.range(1).select(F.lit("s").alias("sku"), ids(300).alias("a"), ids(300).alias("b"), ids(10).alias("c"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = hierarchy.combinations(df, ["a", "b", "c"])
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 900_000 and len(sizes) == 8 and max(sizes) <= 250_000
    assert rows.distinct().count() == 900_000


def test_publish_stage_numbers_distinct_rows(make):
    rows = make([("b", "1"), ("a", "2"), ("a", "1"), ("a", "1"), (None, "9")], "k string, v string")
    got = sorted((r.id, r.k, r.v, r.created_at, r.sitemap_exclude) for r in publish.publish_stage(rows, ["k", "v"], ["k"]).collect())
    assert got == [(1, None, "9", "", ""), (2, "a", "1", "", ""), (3, "a", "2", "", ""), (4, "b", "1", "", "")]
