from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from skuloom.operators import eav
from skuloom.plans.inputs import load_time
from skuloom.sources.schemas import INPUT_FILTER, PRODUCT_ATTRIBUTES


def attribute(identifier, *values, name="n"):
    return (identifier, name, [(v, None, None, u) for v, u in values])


def product(sku, brand, *attributes, name="P"):
    return (sku, name, brand, None, "d", None, list(attributes))


def control(make, *ids):
    return make([("s", "t", i, None, flag, None) for i, flag in ids], INPUT_FILTER)


def rows(df):
    return sorted((r.sku, r.atributo, r.valor) for r in df.select("sku", "atributo", "valor").collect())


def build(make, products, *ids):
    df = make(products, PRODUCT_ATTRIBUTES)
    return eav.eav_build(df, control(make, *ids), "o", load_time())


def test_eav_build_rules(make):
    products = [
        product("1", "A", attribute("Cor", ("b", None), ("a", "")), attribute("Peso", ("2", "kg"))),
        product("1", "A", attribute("Cor", ("b", None), ("a", ""))),  # a copy adds nothing
        product("2", None, attribute("Cor", ("x", None))),  # no brand: only the brand row
        product("3", "A", attribute("brand", ("A", None)), attribute("Velho", ("x", None)), attribute("Cor")),
        product("4", "A", attribute("Cor", (None, "cm"))),
    ]
    result = build(make, products, ("COR", "1"), ("peso", "true"), ("brand", "1"), ("velho", "0"))
    assert set(rows_safe(result)) == {
        ("1", "Cor", "a ; b"), ("1", "Peso", "2 kg"), ("4", "Cor", ""), ("1", "marca", "A"),
        ("3", "marca", "A"), ("4", "marca", "A"), ("2", "marca", None),
    }


def rows_safe(df):
    return [(r.sku, r.atributo, r.valor) for r in df.collect()]


def test_eav_build_keeps_one_text_per_brand(make):
    products = [
        product("1", "A", attribute("Cor", ("x", None))),
        product("1", "B", attribute("Cor", ("y", None), ("z", None))),
        product("1", "C", attribute("Cor", ("x", None))),
    ]
    result = build(make, products, ("cor", "1")).where("atributo = 'Cor'")
    assert rows(result) == [("1", "Cor", "x"), ("1", "Cor", "y ; z")]


def test_same_value_under_two_ids_is_repeated(make):
    values = [("v", "1", None, None), ("v", "2", None, None)]
    df = make([("1", "P", "A", None, "d", None, [("cor", "n", values)])], PRODUCT_ATTRIBUTES)
    result = eav.eav_build(df, control(make, ("cor", "1")), "o", load_time()).where("atributo = 'cor'")
    assert rows(result) == [("1", "cor", "v ; v")]


def test_unpivot_families_and_pivot_back(make):
    df = make([("1", "a", 5, Decimal("1.50"), True), ("2", None, 7, None, False)],
              "k string, s string, i int, d decimal(8,2), b boolean")
    frames = eav.unpivot_by_family(df, "k", "src", load_time())
    assert sorted(frames) == ["bigint", "boolean", "decimal", "string"]
    assert dict(frames["bigint"].dtypes)["valor"] == "bigint"
    assert rows_safe(frames["string"]) == [("1", "s", "a"), ("2", "s", None)]
    wide = eav.wide_product(list(frames.values()), ["s", "i", "b"])
    assert {tuple(r) for r in wide.select("sku", "s", "i", "b").collect()} == {
        ("1", "a", "5", "true"), ("2", None, "7", "false"),
    }


def test_wide_product_keeps_all_skus_and_compares_numbers_as_numbers(make):
    schema = "sku string, atributo string, valor {}"
    texts = make([(" 1 ", "COR", "a"), ("1", "cor", "b"), ("2", "outro", "x")], schema.format("string"))
    numbers = make([("1", "peso", 9), ("1", "Peso", 10), ("3", "nada", 1)], schema.format("bigint"))
    wide = eav.wide_product([texts, numbers], ["Cor", "peso"])
    assert wide.columns == ["sku", "cor", "peso"]
    assert {tuple(r) for r in wide.collect()} == {("1", "b", "10"), ("2", None, None), ("3", None, None)}


def test_unit_split(make):
    df = make([("1", "12 cm", "3 x"), ("2", "12", None), ("3", None, "a")], "sku string, Largura string, cor string")
    split = eav.unit_split(df, ["LARGURA"])
    assert split.columns == ["sku", "largura", "largura_unid", "cor"]
    assert [tuple(r) for r in split.collect()] == [
        ("1", "12", "cm", "3 x"), ("2", "12", None, None), ("3", None, None, "a"),
    ]
    assert eav.unit_split(df, ["largura"], separate=False).columns == ["sku", "largura", "cor"]


def test_unit_attributes(make):
    df = make([product("1", "A", attribute("Peso", ("1", "kg")), attribute("Cor", ("x", " ")))], PRODUCT_ATTRIBUTES)
    assert eav.unit_attributes(df) == ["peso"]


def test_concat_group_unique(make):
    df = make([("k", "b"), ("k", "a"), ("k", "b"), ("k", None)], "k string, v string")
    assert eav.concat_group(df, ["k"], "v", ";", "o").first().o == "a;b;b"
    assert eav.concat_group(df, ["k"], "v", ";", "o", unique=True).first().o == "a;b"
    assert eav.concat_group(df.where(F.col("v").isNull()), ["k"], "v", ";", "o").first().o == ""


def test_unpivot_keeps_digits_and_nested_columns(make):
    schema = "k int, a decimal(32,0), b decimal(20,15), n array<int>, t array<string>, m map<string,int>"
    df = make([(1, Decimal("9" * 32), Decimal("1.123456789012345"), [1], ["x"], {"q": 2})], schema)
    frames = eav.unpivot_by_family(df, "k", "src", load_time())
    got = {f: {r.atributo: r.valor for r in frame.collect()} for f, frame in frames.items()}
    assert got == {
        "decimal": {"a": "9" * 32, "b": "1.123456789012345"},
        "array": {"n": ["1"], "t": ["x"]},
        "string": {"m": '{"q":2}'},
    }
