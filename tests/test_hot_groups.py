"""Whole results when one key, or copies of one row, hold a third of all rows.

Every case is compared with a few lines of plain Python over the same rows, once with adaptive
execution and once with salting.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skuloom.operators import eav, hierarchy, quality, references, sync
from skuloom.operators.joins import Link, link_star
from skuloom.plans.inputs import load_time
from skuloom.sources import schemas as S

N = 3000


@pytest.fixture(params=["adaptive", "salted"])
def mode(request, spark):
    """Shuffle joins only, with hot keys split at run time or by salt."""
    adaptive = "true" if request.param == "adaptive" else "false"
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], adaptive)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def hot_key(i: int) -> str:
    return "hot" if i % 3 == 0 else f"k{i % 200}"


def test_concat_of_a_hot_key_and_of_copies(mode, make):
    rows = [(hot_key(i), str(i % 7) if i % 2 else "copy") for i in range(N)]
    expected = defaultdict(list)
    for k, v in rows:
        expected[k].append(v)
    df = make(rows, "k string, v string")
    got = {r.k: r.t for r in eav.concat_group(df, ["k"], "v", ";", "t").collect()}
    assert got == {k: ";".join(sorted(v)) for k, v in expected.items()}
    unique = {r.k: r.t for r in eav.concat_group(df, ["k"], "v", ";", "t", unique=True).collect()}
    assert unique == {k: ";".join(sorted(set(v))) for k, v in expected.items()}


def test_reference_lists_of_a_hot_sku(mode, make):
    def docs(schema, rows):
        return make(
            [(sku, "P", "A", None, None, ([([("COD_MATERIAL", code), ("EAN", "x")],)],)) for sku, code in rows], schema
        )

    related = [(hot_key(i), str(i % 11)) for i in range(N)]
    installation = [(f"k{i % 50}", str(i % 5)) for i in range(300)]

    def joined(rows):
        lists = defaultdict(list)
        for sku, code in rows:
            lists[sku].append(code)
        return {sku: ";".join(sorted(codes)) for sku, codes in lists.items()}

    left, right = joined(related), joined(installation)
    got = references.reference_lists(docs(S.PRODUCT_RELATED, related), docs(S.PRODUCT_INSTALLATION, installation))
    assert {tuple(r) for r in got.collect()} == {(k, left.get(k), right.get(k)) for k in left.keys() | right.keys()}


def test_eav_of_copied_documents(mode, make):
    def document(i):
        sku = hot_key(i)
        value = "v" if sku == "hot" else str(i % 3)
        return (sku, "P", "A", None, "d", None, [("Cor", "n", [(value, None, None, "cm")])])

    documents = [document(i) for i in range(N)]
    control = make([("s", "t", "cor", None, "1", None)], S.INPUT_FILTER)
    built = eav.eav_build(make(documents, S.PRODUCT_ATTRIBUTES), control, "o", load_time())
    expected = defaultdict(set)
    for d in documents:
        expected[d[0]].add(d[6][0][2][0][0] + " cm")
    got = {r.sku: r.valor for r in built.where("atributo = 'Cor'").collect()}
    assert got == {sku: " ; ".join(sorted(texts)) for sku, texts in expected.items()}
    assert built.where("atributo = 'marca'").count() == len(expected)


def test_wide_product_of_copies(mode, make):
    rows = [(hot_key(i), "cor" if i % 2 else "peso", str(i % 13)) for i in range(N)]
    best = {}
    for sku, name, value in rows:
        best[sku, name] = max(value, best.get((sku, name), ""))
    wide = eav.wide_product([make(rows, "sku string, atributo string, valor string")], ["cor", "peso"])
    skus = {sku for sku, _, _ in rows}
    assert {tuple(r) for r in wide.collect()} == {(s, best.get((s, "cor")), best.get((s, "peso"))) for s in skus}


def test_images_of_a_hot_owner(mode, make):
    schema = "sku string, id string, v string"
    target = [(hot_key(i), str(i), "old") for i in range(N)]
    stage = [(hot_key(i), str(i), "new") for i in range(0, N, 2) if hot_key(i) != "k1"] + [("fresh", "1", "new")] * 40
    owners, staged = {r[0] for r in target}, {r[0] for r in stage}
    new = {(s, i): v for s, i, v in stage}
    expected = {
        ("D" if s not in staged else "U" if (s, i) in new else "=", s, i, new.get((s, i), v) if s in staged else v)
        for s, i, v in target
    } | {("I", s, i, v) for s, i, v in stage if s not in owners}
    got = [tuple(r) for r in sync.sync_by_owner(make(target, schema), make(stage, schema), "sku", ["sku", "id"]).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_urls_shared_by_many_targets(mode, make):
    targets = [("produto", str(i), hot_key(i)) for i in range(N)]
    statuses = {u: 404 if u in ("hot", "k7") else 200 for _, _, u in targets}
    crawl = make([(u, s, "") for u, s in statuses.items()], "url string, status int, body string")
    found = quality.url_health(make(targets, "origem string, sku string, url string"), crawl)
    assert {(r.sku, r.url) for r in found.collect()} == {(s, u) for _, s, u in targets if statuses[u] == 404}
    assert found.count() == sum(statuses[u] == 404 for _, _, u in targets)


def test_links_to_a_hot_item(mode, make):
    links = [(i % 100, 0 if i % 3 == 0 else i % 17) for i in range(N)]
    owners = make([(i, f"o{i}") for i in range(101)], "id int, nome string")
    items = make([(i, f"t{i:02d}") for i in range(17)], "id int, title string")
    star = link_star(owners, "id", [Link("f", make(links, "o int, i int"), "o", "i", items, "id", "title")])
    expected = defaultdict(set)
    for owner, item in links:
        expected[owner].add(f"t{item:02d}")
    assert {r.id: r.f for r in star.collect()} == {i: ";".join(sorted(expected[i])) for i in range(101)}


def test_hierarchy_links_of_copied_skus(mode, make):
    rows = [(hot_key(i), "A", ["r", "x" if hot_key(i) == "hot" else f"n{i % 4}"]) for i in range(N)]
    primary = make([(s, "P", b, None, None, None, (p,)) for s, b, p in rows], S.PRODUCT_PRIMARY)
    nothing = [make([], schema) for schema in (S.PRODUCT_MARKETING, S.PRODUCT_WEBSITE)]
    link = hierarchy.hierarchy_link(primary, *nothing, "o", load_time())
    got = Counter((r.sku, r.hierarquia_primaria) for r in link.collect())
    assert got == Counter({(s, p[-1]) for s, _, p in rows})


def test_upsert_with_copied_updates(mode, spark, make):
    target = make([(f"k{i}", "old") for i in range(100)], "k string, v string")
    updates = make([(hot_key(i), "new") for i in range(N)], "k string, v string")
    merged = sync.upsert_all(target, updates, ["k"])
    touched = {hot_key(i) for i in range(N)}
    expected = {f"k{i}": "old" for i in range(100)} | {k: "new" for k in touched}
    assert {r.k: r.v for r in merged.collect()} == expected
    assert merged.count() == len(expected) == merged.select(F.countDistinct("k")).first()[0]


def test_upsert_into_rows_without_a_key(mode, spark, make):
    """A third of the target has no key: those rows stay, unmatched and spread over tasks."""
    rows = [(None if i % 3 == 0 else f"k{i}", i) for i in range(N)]
    target = make(rows, "k string, v int").repartition(8)
    updates = make([(None, -1), (None, -1), (None, -2), ("k1", -1), ("new", -1)], "k string, v int")
    merged = sync.upsert_all(target, updates, ["k"])
    expected = Counter((k, -1 if k == "k1" else v) for k, v in rows) + Counter([(None, -1), (None, -1), (None, -2), ("new", -1)])
    assert Counter(map(tuple, merged.collect())) == expected
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        empty = merged.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(empty) > 2
