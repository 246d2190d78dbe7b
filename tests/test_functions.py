from __future__ import annotations

from decimal import Decimal
from urllib.parse import quote

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom.functions import arrays, text, types


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_blank_and_norm(make):
    df = make([(None,), ("",), ("   ",), (" Ab ",)], "x string")
    rows = df.select(text.is_blank(F.col("x")).alias("b"), text.norm(F.col("x")).alias("n")).collect()
    assert [r.b for r in rows] == [True, True, True, False]
    assert [r.n for r in rows] == [None, "", "", "ab"]


def test_flag_reads_numbers_words_and_booleans(spark, make):
    df = make([("1",), ("true",), (" SIM ",), ("0",), ("false",), ("",), (None,)], "x string")
    assert [r.f for r in df.select(text.flag(F.col("x")).alias("f")).collect()] == [True] * 3 + [False] * 4
    assert value(spark, text.flag(F.lit(1))) is True
    assert value(spark, text.flag(F.lit(True))) is True
    assert value(spark, text.flag(F.lit(False))) is False


def test_with_unit(make):
    df = make([("12", "cm"), ("12", " "), ("12", None), (None, "cm")], "v string, u string")
    assert [r.t for r in df.select(text.with_unit(F.col("v"), F.col("u")).alias("t")).collect()] == [
        "12 cm", "12", "12", None,
    ]


def test_url_text(spark):
    assert value(spark, text.fold_accents(F.lit("ÁÇÃO é Ü"))) == "acao e u"
    path = "a b/ç~x_y.z-1*(é)+%#?&="
    assert value(spark, text.encode_url(F.lit(path))) == quote(path)
    assert value(spark, text.strip_brackets(F.lit("[{a}]"))) == "a"
    assert value(spark, text.without(F.lit('1/2"3'), "/", '"')) == "123"
    assert value(spark, text.decimal_comma(F.lit(Decimal("33.30")))) == "33,30"


def test_joined_is_sorted_and_skips_null(spark):
    values = F.array(F.lit("b"), F.lit(None).cast("string"), F.lit("a"))
    assert value(spark, text.joined(values, ";")) == "a;b"


def test_blank_fill_and_lower_columns(make):
    df = make([(None, " x "), (3, None)], "A int, b string")
    assert [tuple(r) for r in text.blank_fill(df).collect()] == [("", "x"), ("3", "")]
    assert text.lower_columns(df, "B").columns == ["a"]


@settings(max_examples=25, deadline=None)
@given(paths=st.lists(st.lists(st.sampled_from(["a", "b", None]), max_size=8), min_size=1, max_size=6))
def test_deepest_is_the_last_filled_of_six(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p array<string>")
    expected = [next((x for x in reversed(p[:6]) if x is not None), None) for p in paths]
    assert [r.d for r in df.select(arrays.deepest(F.col("p")).alias("d")).collect()] == expected


def test_level_outside_the_path_is_null(make):
    df = make([(["a"],), ([],), (None,)], "p array<string>")
    assert [r.x for r in df.select(arrays.level(F.col("p"), 3).alias("x")).collect()] == [None] * 3


def test_type_families(spark):
    schema = T.StructType.fromDDL(
        "a string, b int, c bigint, d decimal(5,2), e double, f boolean, g binary, h timestamp, "
        "i date, j array<string>, k smallint, l float, m map<string,int>"
    )
    df = spark.createDataFrame([], schema)
    assert types.columns_by_family(df, exclude=("a",)) == {
        "bigint": ["b", "c", "k"], "decimal": ["d"], "float": ["e", "l"], "boolean": ["f"],
        "binary": ["g"], "timestamp": ["h"], "date": ["i"], "array": ["j"],
    }


def test_catalogue_types(make):
    rows = [("LOV", None), ("number", None), ("number", "(18,2)"), ("isodate", None), (None, None), ("double", None)]
    df = make(rows, "t string, p string")
    assert [r.x for r in df.select(types.catalogue_type(F.col("t"), F.col("p")).alias("x")).collect()] == [
        "string", "numeric", "numeric (18,2)", "timestamp", "string", "double",
    ]
