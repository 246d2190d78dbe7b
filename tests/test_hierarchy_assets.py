from __future__ import annotations

from pyspark.sql import functions as F

from skuloom.operators import assets, hierarchy, references
from skuloom.plans.inputs import load_time
from skuloom.sources import schemas as S


def head(sku, brand):
    return (sku, "P", brand, None, None)


def path_docs(make, kind, rows):
    """(sku, brand, value) rows as documents of one path kind."""
    schema = {"primary": S.PRODUCT_PRIMARY, "marketing": S.PRODUCT_MARKETING,
              "website": S.PRODUCT_WEBSITE, "site": S.PRODUCT_SITE}[kind]
    wrap = (lambda v: (v,)) if kind == "primary" else (lambda v: ((v,),))
    return make([(*head(s, b), None, wrap(v)) for s, b, v in rows], schema)


def test_hierarchy_dim_levels(make):
    rows = [("n", "Nome", "M", None, ["a", "b"], None), ("r", "Raiz", "M", None, [], None)]
    dim = hierarchy.hierarchy_dim(make(rows + rows, S.HIERARCHY), load_time())
    got = {r.hierarquia: [r[f"nivel{i}"] for i in range(5)] for r in dim.collect()}
    assert dim.count() == 2
    assert got == {"n": ["a", "b", "", "", ""], "r": [None, "", "", "", ""]}


def test_hierarchy_link_uses_all_sources(make):
    primary = path_docs(make, "primary", [("1", "A", ["x", "y"]), ("1", "A", ["x", "y"]), ("3", "A", ["p"])])
    marketing = path_docs(make, "marketing", [("1", "B", [["m"]]), ("2", "B", [["m", "n"], ["ignored"]])])
    website = path_docs(make, "website", [("2", None, [["w"]])])
    link = hierarchy.hierarchy_link(primary, marketing, website, "o", load_time())
    assert {tuple(r)[:5] for r in link.collect()} == {
        ("1", "A", "y", "m", None), ("2", "B", None, "n", "w"), ("3", "A", "p", None, None),
    }


def test_hierarchy_link_keeps_several_nodes(make):
    primary = path_docs(make, "primary", [("1", "A", ["x"]), ("1", "A", ["y"])])
    none = path_docs(make, "marketing", [])
    link = hierarchy.hierarchy_link(primary, none, path_docs(make, "website", []), "o", load_time())
    assert sorted(r.hierarquia_primaria for r in link.collect()) == ["x", "y"]


def test_site_paths_in_both_shapes(make):
    nested = ['["SITE-Site","a"]', '["one"]', '["r","b"]', '[" SITE-Site ","c"]', '["r","s","t"]']
    rows = [
        ("nested", "A", [nested]),
        ("nested", "A", [nested]),
        ("flat", "A", [["r", "s"]]),
        ("root", "A", [["only"]]),
        ("empty", "A", [[]]),
        ("null", "A", None),
        ("mixed", "A", [["plain", '["r","q"]']]),
    ]
    got = {(r.sku, r.idx, r.hierarquia) for r in hierarchy.site_paths(path_docs(make, "site", rows)).collect()}
    assert got == {
        ("nested", 2, "b"), ("nested", 4, "t"), ("flat", 0, "s"), ("root", 0, "only"), ("mixed", 1, "q"),
    }


def test_on_site(make):
    products = make([("1", " SIM "), ("2", "nao"), ("3", "sim"), ("4", "sim")], "sku string, status_exib_site string")
    links = make([("1", "h"), ("1", "h"), ("2", "h"), ("3", "shallow")], "sku string, hierarquia string")
    dim = make([("h", "a", "b"), ("shallow", "a", None)], "hierarquia string, nivel1 string, nivel2 string")
    assert [r.sku for r in hierarchy.on_site(products, links, dim).collect()] == ["1"]


def test_reference_lists(make):
    def docs(schema, rows):
        return make([(*head(s, "A"), ([(keys,) for keys in items],)) for s, items in rows], schema)

    code, ean = (lambda v: ("COD_MATERIAL", v)), ("EAN", "0")
    related = docs(S.PRODUCT_RELATED, [("1", [[code("b"), ean], [code("a")]]), ("2", [[ean]])])
    installation = docs(S.PRODUCT_INSTALLATION, [("1", [[code("z")]]), ("3", [[code("q")], [code("q")]])])
    got = {tuple(r) for r in references.reference_lists(related, installation).collect()}
    assert got == {("1", "a;b", "z"), ("3", None, "q;q")}


def asset(identifier, type_id, url="u", attributes=(("asset.cor", "Cor", [("v", None)]),), resize=None):
    base = (identifier, f"arq {identifier}", "T", url, "1", (type_id, "Nome, tipo"), [tuple(a) for a in attributes])
    return base if resize is None else (*base, resize)


def active(make, *ids):
    return make([("s", "t", i, None, "1", None) for i in ids], S.INPUT_FILTER)


def test_document_assets(make):
    attributes = [("ASSET.Cor", "Cor", [("a", None), ("b", None)]), ("asset.x", "X", [("y", None)]), ("asset.n", "N", None)]
    docs = make([(*head("1", "A"), None, ([asset("d1", "DOC-manual", attributes=attributes)],))], S.PRODUCT_DOCUMENTS)
    wide = assets.document_assets(docs, active(make, "asset.cor", "asset.n"), ["asset.cor", "asset.n"])
    row = wide.first().asDict()
    assert wide.count() == 1
    assert (row["asset.cor"], row["asset.n"], row["descricao"], row["versao"]) == ("b", None, "Nome, tipo", "1")


def test_image_assets_split_by_unit(make):
    attributes = [("asset.w", "Largura", [("1", "cm"), ("2", "cm"), ("9", "px")])]
    image = asset("i1", "IMG-frente", attributes=attributes, resize=["g"])
    docs = make([(*head("1", "A"), None, ([image],))], S.PRODUCT_IMAGES)
    wide = assets.image_assets(docs, active(make, "asset.w"), ["asset.w"])
    assert {(r.tipo_imagem, r.unidade_medida, r["asset.w"]) for r in wide.collect()} == {
        ("frente", "cm", "2"), ("frente", "px", "9"),
    }


def test_documents_by_type_needs_an_attribute_value(make):
    docs = [asset("d1", "DOC-a", "u1"), asset("d2", "DOC-a", "u2"), asset("d3", "DOC-b", "u3", attributes=())]
    documents = make([(*head("1", "A"), None, (docs,))], S.PRODUCT_DOCUMENTS)
    products = make([("1", "x"), ("2", "y")], "sku string, extra string")
    wide = assets.documents_by_type(products, documents, ["doc-a", "doc-b"])
    assert {(r.sku, r["doc-a"], r["doc-b"]) for r in wide.collect()} == {("1", "u2", None), ("2", None, None)}
    assert wide.count() == 2


def test_image_sizes_from_text_and_array(make):
    text = make([("1", "[[a, b, c, d, e, {f}]]"), ("2", "[[a]]"), ("3", None)], "sku string, resize string")
    names = [f"tamanho_{s}" for s in ("g", "m", "p", "sqr_1_k", "gg", "ggg")]
    rows = {r.sku: [r[n] for n in names] for r in assets.image_sizes(text).collect()}
    assert rows == {"1": list("abcdef"), "2": ["a"] + [None] * 5, "3": [None] * 6}
    listed = make([("1", ["[a]", "b"])], "sku string, resize array<string>")
    assert [assets.image_sizes(listed).first()[n] for n in names[:3]] == ["a", "b", None]


def test_asset_names_are_found(make):
    attributes = [("ASSET.Cor", "Cor", [("a", None)]), ("asset.novo", "N", [("z", None)]), ("asset.x", "X", [("y", None)])]
    docs = make([(*head("1", "A"), None, ([asset("d1", "DOC-novo", "u", attributes=attributes)],))], S.PRODUCT_DOCUMENTS)
    wide = assets.document_assets(docs, active(make, "asset.cor", "asset.novo"))
    assert [c for c in wide.columns if c.startswith("asset.")] == ["asset.cor", "asset.novo"]
    assert assets.documents_by_type(make([("1",)], "sku string"), docs).first()["doc-novo"] == "u"
