from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skuloom import session
from skuloom.operators import control
from skuloom.plans.inputs import load_time
from skuloom.sources import control as sheets
from skuloom.sources import documents, relational, schemas, tables


def test_shared_dir_comes_from_the_session(spark):
    folder = session.shared_dir(spark)
    configured = spark.conf.get(session.CHECKPOINT_CONF, None)
    assert folder == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert session.new_dir(spark, "x") != session.new_dir(spark, "x")


def test_a_cluster_without_shared_dir_is_refused():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_read_collection_lines_and_array(spark, tmp_path):
    docs = [
        {"sku": "1", "brand": "A", "attributes": [{"id": "x", "name": "X", "values": [{"value": "1", "uom": "cm"}]}]},
        {"sku": "2", "attributes": None},
        {"sku": "3"},
    ]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, docs)))
    (tmp_path / "array.json").write_text(json.dumps(docs, indent=1))
    lines = documents.read_collection(spark, str(tmp_path / "lines.json"), "product_attributes")
    array = documents.read_collection(spark, str(tmp_path / "array.json"), "product_attributes", multiline=True)
    for df in (lines, array):
        assert [r.sku for r in df.collect()] == ["1"]
        assert df.select(F.inline("attributes")).select(F.inline("values")).first().uom == "cm"


def test_every_collection_schema_holds_its_required_field(spark):
    for schema, required in schemas.COLLECTIONS.values():
        assert spark.createDataFrame([], schema).select(required).count() == 0


def test_document_timestamp(make):
    df = make([('{"$date":"2024-01-02T03:04:05Z"}',), ("2024-01-02",), ("bad",), (None,)], "updateDate string")
    got = [r.t and str(r.t) for r in df.select(documents.document_timestamp("updateDate").alias("t")).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-02 00:00:00", None, None]


def test_jdbc_options():
    connection = {"user": "u", "password": "p", "driver": "d"}
    plain = relational.jdbc_read_options("jdbc:x", "select 1 ;", connection)
    assert plain["dbtable"] == "(select 1) q" and plain["user"] == "u" and "numPartitions" not in plain
    split = relational.jdbc_read_options("jdbc:x", "select 1", connection, "id", (1, 100), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "8")
    with pytest.raises(ValueError):
        relational.jdbc_read_options("jdbc:x", "select 1", connection, "id")
    write = relational.jdbc_write_options("jdbc:x", "stage.t", connection, batch_size=5)
    assert write["truncate"] == "true" and write["batchsize"] == "5" and write["dbtable"] == "stage.t"


def test_control_table_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("sistema_destino,id_atributo_catalogo,id_atributo_saida,ativo\nsite,a,,1\n")
    row = sheets.load_control_table(spark, str(path), "filtro_saida").first()
    assert (row.sistema_destino, row.id_atributo_saida, row.ativo) == ("site", None, "1")
    stored = sheets.refresh_control_table(spark, str(path), "filtro_saida", str(tmp_path / "control"))
    assert tables.read_table(spark, stored).count() == 1
    with pytest.raises(ValueError):
        sheets.load_control_table(spark, str(path), "outra")


def test_active_ids_and_schema_rows(make):
    inputs = make([("s", "t", " COR ", None, "1", None), ("s", "t", "cor", None, "sim", None), ("s", "t", "x", None, "0", None)],
                  schemas.INPUT_FILTER)
    assert [r.id_ativo for r in control.active_ids(inputs).collect()] == ["cor"]
    named = make([("s", "t", " A ", "X", "0", None), ("s", "t", "b", "", "1", None), ("s", "t", "c", None, "1", None)], schemas.INPUT_FILTER)
    assert control.rename_map(named) == {"a": "x"}
    rows = control.schema_rows(make([], "A int, `b ` string"), "sis", "tab", load_time())
    assert [(r.sistema_origem, r.tabela_origem, r.id_atributo_entrada, r.ativo) for r in rows.collect()] == [
        ("sis", "tab", "a", "false"), ("sis", "tab", "b", "false"),
    ]


def test_overwrite_append_and_versions(spark, make, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(make([(1,)], "a int"), path)
    tables.overwrite_table(make([(2,)], "a int"), path)
    tables.append_evolving(make([(3, "n")], "a int, b string"), path)
    got = {(r.a, r.b) for r in tables.read_table(spark, path, evolve=True).collect()}
    assert got == {(2, None), (3, "n")}
    version = tables.write_version(tables.read_table(spark, path).where("a = 2"), "t")
    assert version != path and tables.read_table(spark, version).count() == 1


def test_replace_slice_touches_only_its_own(spark, make, tmp_path):
    path = str(tmp_path / "t")
    schema = "origem string, v int"
    tables.replace_slice(make([("a", 1), ("a", 2), ("b", 3)], schema), path)
    tables.replace_slice(make([("a", 9)], schema), path)
    assert {(r.origem, r.v) for r in tables.read_table(spark, path).collect()} == {("a", 9), ("b", 3)}


def test_tables_like(spark, make):
    for name in ("zz_string", "zz_bigint", "zz_link_x", "other"):
        make([(1,)], "a int").createOrReplaceTempView(name)
    assert tables.tables_like(spark, "zz_*") == ["zz_bigint", "zz_link_x", "zz_string"]
    assert tables.tables_like(spark, "zz_*", exclude="*_link*") == ["zz_bigint", "zz_string"]


def test_brand_view(make):
    df = make([("1", " DECK ", "x", "f"), ("2", "other", "y", "f"), ("3", None, "z", "f")], "sku string, marca string, a string, fix string")
    view = tables.brand_view(df, "Deck", df.columns, ["sku"], fixed=("fix",))
    assert [tuple(r) for r in view.collect()] == [("1", "x")]
    assert tables.publish_view(view, "v_deck").columns == ["sku", "a"]


def test_replace_slice_empties_a_loaded_source(spark, make, tmp_path):
    path, schema = str(tmp_path / "t"), "origem string, x int"
    tables.replace_slice(make([("a", 1), ("b/c", 2), ("d", 3)], schema), path)
    tables.replace_slice(make([("a", 9)], schema), path, slices=["a", "b/c"])
    got = {tuple(r) for r in spark.read.parquet(path).select("origem", "x").collect()}
    assert got == {("a", 9), ("d", 3)}
