from __future__ import annotations

from pyspark.sql import functions as F

from skuloom.constants import NOT_FOUND_PHRASE
from skuloom.operators import completeness as C
from skuloom.operators import quality as Q
from skuloom.sources import schemas as S
from skuloom.sources import tables

SOURCE = "sku string, a string, b string, c string"


def two(make):
    left = make([(" 1", "X ", None, "same"), ("2", None, "v", "same"), ("3", "only left", None, "s"), ("4", "-1", "q", "r")], SOURCE)
    right = make([("1 ", "x", "", "same"), ("2", "new", "w", "SAME "), ("4", None, "q", "r"), ("5", "only right", None, "s")], SOURCE)
    return left, right, ["a", "b", "c"]


def test_column_diff(make):
    left, right, columns = two(make)
    assert {tuple(r) for r in Q.column_diff(left, right, "sku", columns).collect()} == {
        ("1", "b", None, ""), ("2", "a", None, "new"), ("2", "b", "v", "w"), ("4", "a", "-1", None),
    }


def test_diff_of_a_table_with_itself_is_empty(make):
    left, _, columns = two(make)
    assert Q.column_diff(left, left, "sku", columns).count() == 0
    assert Q.diff_matrix(left, left, "sku", columns, drop_equal=True).columns == ["sku"]


def test_diff_matrix(make):
    left, right, columns = two(make)
    whole = Q.diff_matrix(left, right, "sku", columns)
    assert whole.columns[-2:] == ["site_c", "catalogo_c"]
    matrix = Q.diff_matrix(left, right, "sku", columns, drop_equal=True)
    assert matrix.count() == whole.count()
    assert matrix.columns == ["sku", "site_a", "catalogo_a", "site_b", "catalogo_b"]
    assert {tuple(r) for r in matrix.collect()} == {
        ("1", "", "", "", ""), ("2", "", "new", "v", "w"), ("4", "-1", "", "", ""),
    }


def test_side_by_side_reads_null_as_blank(make):
    left, right, columns = two(make)
    assert Q.shared_columns(left, right, "sku") == columns
    got = {r.sku: (r.validar_a, r.validar_b, r.validar_c) for r in Q.side_by_side(left, right, "sku", columns).collect()}
    assert got == {"1": (True, True, True), "2": (False, False, True), "4": (False, True, True)}


def product(sku, brand, *attributes):
    return (sku, "P", brand, None, None, None, [(i, n, [(v, None, None, None)]) for i, n, v in attributes])


def test_invalid_numbers(make):
    rows = [product("1", "A", ("Peso", "n", "12.7"), ("peso ", "n", "x"), ("cor", "n", "x")),
            product("2", "A", ("peso", "n", "12345678901"), ("peso", "n", None), ("peso", "n", "")),
            product("3", None, ("peso", "n", "x"))]
    ids = make([("peso",)], "id_atributo_entrada string")
    found = Q.invalid_numbers(make(rows, S.PRODUCT_ATTRIBUTES), ids)
    assert {(r.sku, r.valor) for r in found.collect()} == {("1", "x"), ("2", "12345678901"), ("2", None), ("2", "")}
    none = make([], "id_atributo_entrada string")
    findings = Q.attribute_findings(make(rows, S.PRODUCT_ATTRIBUTES), none, ids)
    assert findings.columns == Q.FINDING
    assert {(r.regra, r.sku, r.id, r.valor) for r in findings.collect()} == {
        (Q.INVALID_NUMBER, r.sku, "peso", r.valor) for r in found.collect()
    }


def asset(identifier, name, url, attributes):
    return (identifier, name, "T", url, "1", ("DOC-x", "X"), attributes)


def test_blank_names_and_urls(make):
    nameless = [("Asset.A", " ", None), ("b", "B", None)]
    docs = [
        ("1", "P", "A", None, None, None, ([asset(" D1", "", "u", nameless), asset("d2", "n", " ", None)],)),
        ("2", "P", None, None, None, None, ([asset("d3", "n", None, []), asset("d4", "n", "", [])],)),
        ("3", "P", "A", None, None, None, ([asset("d5", "n", None, [])],)),
        ("3", "P", "A", None, None, None, ([asset("d5", "n", None, [])],)),
    ]
    documents = make(docs, S.PRODUCT_DOCUMENTS)
    images = make([(*d[:6], ([(*a, ["r"]) for a in d[6][0]],)) for d in docs], S.PRODUCT_IMAGES)
    products = make([product("1", "A", ("Cor", None, "x")), product("2", "A", ("cor", None, "y")), product("3", "A", ("off", "", "y"))],
                    S.PRODUCT_ATTRIBUTES)
    names = Q.blank_names(products, make([("cor",)], "id_atributo_entrada string"), documents, images)
    assert sorted((r.origem, r.sku or "", r.id) for r in names.collect()) == [
        ("golden_record.attributes", "", "cor"),
        ("golden_record.documents", "1", "d1"), ("golden_record.documents.attributes", "1", "asset.a"),
        ("golden_record.images", "1", "d1"), ("golden_record.images.attributes", "1", "asset.a"),
    ]
    cor, nothing = make([("cor",)], "id_atributo_entrada string"), make([], "id_atributo_entrada string")
    everything = Q.findings(products, cor, nothing, documents, images)
    assert everything.where(F.col("regra") == Q.BLANK_NAME).count() == names.count()
    urls = sorted((r.origem, r.sku, r.id) for r in Q.blank_urls(documents, images).collect())
    doc_urls = [("golden_record.documents", s, i) for s, i in (("1", "d2"), ("2", "d4"), ("3", "d5"))]
    image_urls = [("golden_record.images", s, i) for s, i in (("1", "d2"), ("2", "d4"), ("3", "d5"), ("3", "d5"))]
    assert urls == doc_urls + image_urls


def test_asset_checks_read_only_their_fields(spark, make, tmp_path):
    nameless = [("a", None, [("v", None)])]
    docs = [("1", "P", "A", None, None, None, ([asset("d1", "", None, nameless)],))]
    whole = make(docs, S.PRODUCT_DOCUMENTS)
    path = tables.overwrite_table(whole, str(tmp_path / "docs"))
    narrow = Q.asset_findings(tables.read_table(spark, path, schema=S.asset_check_fields("documents")), "documents")
    scan = next(line for line in narrow._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line)
    assert "attributes:array<struct<id:string,name:string>>" in scan and "values" not in scan
    assert sorted(narrow.collect()) == sorted(Q.asset_findings(whole, "documents").collect())
    assert narrow.count() == 3


def test_url_targets_with_a_site_prefix(make):
    nothing = make([], S.PRODUCT_DOCUMENTS), make([], S.PRODUCT_IMAGES)
    pages = make([("1", " a b/ç "), ("2", None), ("1", "a b/ç")], "sku string, caminho string")
    got = Q.url_targets(*nothing, pages, "caminho", prefix="https://s/")
    assert [tuple(r) for r in got.collect()] == [("produto", "1", "https://s/a%20b/%C3%A7")]


def test_url_health(make):
    crawl = make([("ok", 200, "fine"), ("lost", 404, None), ("down", -1, None), ("soft", 200, f"<p>{NOT_FOUND_PHRASE}</p>"),
                  ("redirect", 301, ""), ("odd", 100, ""), ("unused", 500, "")], "url string, status int, body string")
    targets = make([("produto", str(i), u) for i, u in enumerate(["ok", "lost", "down", "soft", "redirect", "odd", "lost", "new"])],
                   "origem string, sku string, url string")
    got = {(r.sku, r.url, r.status, r.situacao) for r in Q.url_health(targets, crawl).collect()}
    assert got == {("1", "lost", 404, "erro_http"), ("6", "lost", 404, "erro_http"), ("2", "down", -1, "sem_resposta"),
                   ("3", "soft", 200, "pagina_inexistente"), ("4", "redirect", 301, "erro_http")}


EAV = "sku string, atributo string, valor string"


def completeness_case(make, required=True):
    primary = make([("1", ["r", "n1", "n2"]), ("2", ["r"]), ("3", ["r"]), ("4", ["r", None, "n2"]),
                    ("5", ["a", "b", "c", "d", "e", "deep"])], "sku string, p array<string>")
    primary = primary.select("sku", F.struct(F.col("p").alias("primary")).alias("hierarchies"))
    nodes = make([("r", "R", None, None, None, [("Cor", True), ("ref_x", True), ("opc", False)]),
                  ("n1", "N", None, None, None, [("cor", True), ("hierarquia_web", True)]),
                  ("n2", "N", None, None, None, [("peso", True), (None, True)]), ("deep", "D", None, None, None, [("x", True)])], S.HIERARCHY)
    eav = make([(s, "STATUS_EXIB_SITE", v) for s, v in (("1", "SIM"), ("2", "sim"), ("3", "nao"), ("4", "Sim"), ("5", "sim"))]
               + [("1", "COR ", "b"), ("1", "cor", "a"), ("2", "cor", None), ("4", "opc", "x")], EAV)
    return C.completeness(primary, nodes, eav, required)


def test_completeness_rules(make):
    got = {(r.sku, r.atributo_hierarquia): (r.obrigatorio, r.valor, r.preenchido) for r in completeness_case(make).collect()}
    assert got == {
        ("1", "Cor"): ("Sim", "b", "Sim"), ("1", "cor"): ("Sim", "b", "Sim"), ("1", "peso"): ("Sim", None, "Não"),
        ("2", "Cor"): ("Sim", None, "Sim"),  # a stored null still counts as filled
        ("4", "Cor"): ("Sim", None, "Não"), ("4", "peso"): ("Sim", None, "Não"),
    }


def test_completeness_of_optional_attributes(make):
    optional = completeness_case(make, required=False)
    assert {(r.sku, r.obrigatorio, r.preenchido) for r in optional.collect()} == {
        ("1", "Não", "Não"), ("2", "Não", "Não"), ("4", "Não", "Sim"),
    }


def test_shares_add_up(make):
    matrix = make([("1", "Sim", "Sim"), ("1", "Sim", "Não"), ("1", "Sim", "Não"), ("2", "Sim", "Sim")],
                  "sku string, obrigatorio string, preenchido string")
    total = {r.preenchido: (r.contagem, r.total, float(r.percentual)) for r in C.completeness_share(matrix).collect()}
    assert total == {"Sim": (2, 4, 50.0), "Não": (2, 4, 50.0)}
    by_sku = {(r.sku, r.preenchido): r.percentual for r in C.completeness_by_sku(matrix).collect()}
    assert by_sku == {("1", "Sim"): "33,33", ("1", "Não"): "66,67", ("2", "Sim"): "100,00"}


def test_share_rounds_the_ratio_first(make):
    matrix = make([("1", "Sim", "Sim"), ("1", "Sim", "Não"), ("1", "Sim", "Não")], "sku string, obrigatorio string, preenchido string")
    assert {r.preenchido: str(r.percentual) for r in C.completeness_share(matrix).collect()} == {"Sim": "33.00", "Não": "67.00"}
