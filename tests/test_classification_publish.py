from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skuloom.operators import classification as C
from skuloom.operators import control, publish
from skuloom.plans.inputs import load_time
from skuloom.sources import schemas


@pytest.fixture
def erp(make):
    text = "string"
    mara = make([(" 1 ", "e1", "LS", "UN", "H1", "10x-20"), ("2", "e2", "ZZ", "UN", "H2", None)],
                "matnr string, ean11 string, spart string, meins string, prdha string, groes string")
    inob = make([("1", "001", "c1"), (" 1", "023", "c1"), ("2", "001 ", "c2")], "objek string, klart string, cuobj string")
    ausp = make(
        [("c1", "10", "001", "X", None, "5"), ("c1", "10 ", "001", "Y", None, None), ("c1", "20", "001", None, "2020", "7"),
         ("c1", "30", "001", None, None, "9"), ("c2", "10", "001", "", None, "3"), ("c2", "99", "001", "Z", None, None)],
        "objek string, atinn string, klart string, atwrt string, date_from string, atflv string")
    cabn = make([("10", "COR"), ("20", "Data"), (" 30", "peso")], f"atinn {text}, atnam {text}")
    cawn = make([("10", "X", "1"), ("10", "Y", "2")], "atinn string, atwrt string, atzhl string")
    cawnt = make([("10", "1", "PT", " Preto "), ("10", "2", "EN", "Yellow")], "atinn string, atzhl string, spras string, atwtb string")
    return mara, inob, ausp, cabn, cawn, cawnt


def test_classification(erp):
    wide = C.classification(*erp[:4], ["cor", "data", "peso"])
    got = {r.sku: (r.formato, r.tipo_classe, r.cor, r.data, r.peso) for r in wide.collect()}
    assert got == {"1": ("10x", "001", "Y", "2020", "9"), "2": (None, "001", "", None, None)}


def test_blank_as_null(erp):
    wide = C.classification(*erp[:4], ["cor"], blank_as_null=True)
    assert {r.sku: r.cor for r in wide.collect()}["2"] == "3"


def test_descriptions_fall_back_to_the_value(erp):
    long = C.classified_values(*erp)
    got = {(r.sku, r.atributo, r.valor): r.caracteristica_interna for r in long.collect()}
    assert got == {
        ("1", "cor", "X"): "Preto", ("1", "cor", "Y"): "Y", ("1", "data", "2020"): "2020",
        ("1", "peso", "9"): "9", ("2", "cor", ""): "",
    }


def test_commercial_view(make):
    materials = make([("1", "LS", "e", "UN", "ABCDEFGHIJ", None, "l2", "pm"), ("2", "01", "e", "UN", "H", "l1", "l2", None),
                      ("3", "ZZ", "e", "UN", "H", None, None, None)],
                     "sku string, setor_atividade string, codigo_barras string, unidade_medida_basica string, "
                     "prdha string, a string, b string, c string")
    products = make([("1", None, None, "sap", None, "amb", "cat")],
                    "sku string, marca string, status_venda string, status_venda_sap string, padrao string, "
                    "ambiente string, categoria string")
    rules = C.CommercialRules(("a", "b"), ("c",), ("c",), "b", ("categoria",))
    got = {r.sku: r.asDict() for r in C.commercial_view(products, materials, rules).collect()}
    assert set(got) == {"1", "2"}
    one = got["1"]
    assert (one["marca"], one["status_venda"], one["codigo_tamanho"], one["segmento"]) == ("LS", "sap", "ABC", "ABCDEFGH")
    assert (one["linha_2"], one["padrao"], one["ambiente"], one["categoria"]) == ("l2", "pm", "amb", "cat")
    assert got["2"]["status_venda"] is None and got["2"]["linha_2"] == "l1"


def test_output_spec_and_typed_publish(spark, make):
    inputs = make([("s", "t", "Largura", "LARG", "1", None), ("s", "t", "larg2", "larg", "sim", None),
                   ("s", "t", "velho", "larg", "0", None), ("s", "t", "data", "dt", "1", None)], schemas.INPUT_FILTER)
    catalogue = make([("larg", "number", "(8,2)", "Largura", "p"), ("DT", "isodate", None, None, "p"),
                      ("nada", "string", None, "Sem entrada", "p")], schemas.ATTRIBUTE_CATALOGUE)
    outputs = make([("SITE", "Larg", "Largura_Final", "1"), ("site", "dt", None, "true"), ("site", "nada", None, "1"),
                    ("loja", "dt", None, "1")], schemas.OUTPUT_FILTER)
    spec = control.spec_rows(control.output_spec(inputs, catalogue, outputs, "Site"))
    assert spec == [("data", "dt", "timestamp", None), ("larg2", "largura_final", "numeric (8,2)", "Largura"),
                    ("largura", "largura_final", "numeric (8,2)", "Largura")]
    loose = control.spec_rows(control.output_spec(inputs, catalogue, outputs, "site", require_active_input=False))
    assert (None, "nada", "string", "Sem entrada") in loose and ("velho", "largura_final", "numeric (8,2)", "Largura") in loose

    df = make([("1", "n/a", "2.345", "2020-01-02"), ("2", "1", "9", "x"), ("2", "1", "9", "x")],
              "sku string, LARG2 string, largura string, data string")
    typed = publish.typed_publish(df, spec)
    assert typed.columns == ["dt", "largura_final", "sku"]
    assert typed.schema["largura_final"].metadata == {"comment": "Largura"}
    assert {tuple(r) for r in typed.collect()} == {
        (datetime.datetime(2020, 1, 2), Decimal("2.35"), "1"), (None, Decimal("1.00"), "2"),
    }
    empty = publish.empty_table(spark, loose)
    assert empty.count() == 0 and dict(empty.dtypes)["largura_final"] == "decimal(8,2)"
    assert empty.schema["nada"].metadata == {"comment": "Sem entrada"}


def test_rename_by_map(make):
    df = make([(1, 2, 3)], "Cod int, outro int, `a.b` int")
    assert publish.rename_by_map(df, {"COD": "CODIGO", "a.B": "ab", "x": "y"}).columns == ["codigo", "outro", "ab"]


LEVELS = "hierarquia string, descricao string, nivel1 string, nivel2 string, nivel3 string, nivel4 string"
HISTORY = "sku string, url string, palavra_chave string, produto_relacionado string, assinatura_arquiteto string"


def test_institutional_urls(make):
    products = make([("1.A", ' Pé "x"/y. z '), ("2", "B"), ("3", "C"), ("9", "sem link")], "sku string, nome_produto string")
    links = make([("1.A", "h"), ("2", "h"), ("3", "top"), ("3", "top")], "sku string, hierarquia string")
    nodes = make([("h", "Nó Final", "Sala Boa", "Mesa", "", ""), ("top", "Raiz", "", "", "", "")], LEVELS)
    history = make([("2", "ANTIGO-2", "kw", None, None)], HISTORY)
    got = {r.sku: r.url_catalogo_institucional for r in
           publish.institutional_urls(products, links, nodes, history, "https://X/").collect()}
    assert got == {
        # level 3 is blank below a filled level 2: the description; level 4 below a blank one: nothing
        "1.A": "https://x/sala-boa/mesa/no-final/pe-xy-z1a",
        "2": "https://x/sala-boa/mesa/no-final/antigo-2",
        "3": "https://x/raiz/c3",
    }


def test_publish_projection(make):
    df = make([("1", "MARCA boa", "x"), ("1", "MARCA boa", "x")], "sku string, marca string, url string")
    out = publish.publish_projection(df, ["sku"], load_time(), {"marca_portfolio": "marca"}, {"url_loja": "url"})
    row = out.first().asDict()
    assert out.count() == 1
    assert (row["marca_portfolio"], row["url_loja"], row["created_by_id"]) == ("Marca Boa", "x", "")
    assert row["created_at"] == row["updated_at"] == datetime.datetime(2024, 1, 1)
    assert row["id"] == df.select(F.xxhash64("sku").alias("h")).first().h


def test_attribute_classes(make):
    inputs = make([("s", "t", " A ", x, "0", None) for x in ("doc", "both", "img", "rec", "num", "none")], schemas.INPUT_FILTER)
    catalogue = make([("doc", "LOV", None, None, "documento"), ("both", "number", None, None, "documento;imagem"),
                      ("img", "LOV", None, None, "imagem"), ("rec", "text", None, None, "produto"),
                      ("num", "number", None, None, "produto"), ("none", "number", None, None, None)], schemas.ATTRIBUTE_CATALOGUE)
    got = {(r.id_atributo_entrada, r.id_atributo_catalogo, r.classe) for r in control.attribute_classes(inputs, catalogue).collect()}
    assert got == {
        ("a", "doc", "documento"), ("a", "both", "documento"), ("a", "both", "imagem"), ("a", "img", "imagem"),
        ("a", "img", "golden_record"), ("a", "img", "lov"), ("a", "rec", "golden_record"), ("a", "rec", "text"),
        ("a", "num", "golden_record"), ("a", "num", "number"),
    }


def test_every_characteristic_gets_its_column(erp, make):
    mara, inob, ausp, cabn = erp[:4]
    wide = C.classification(mara, inob, ausp, cabn.union(make([("99", "Nova")], cabn.schema)))
    assert {r.sku: r.nova for r in wide.collect()} == {"1": None, "2": "Z"}
    assert {"cor", "data", "peso", "nova"} <= set(wide.columns)
