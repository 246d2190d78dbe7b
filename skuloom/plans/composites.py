"""Catalogue operators bound to inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.operators import (
    assets,
    classification,
    completeness,
    control,
    eav,
    hierarchy,
    merge,
    publish,
    quality,
    references,
    site,
    sync,
)
from skuloom.plans import inputs as I
from skuloom.plans import oracle as O
from skuloom.plans.registry import query
from skuloom.session import new_dir
from skuloom.sources import documents, snapshots, tables

ORIGIN = "catalogo"


# --- sources and sinks ------------------------------------------------------------------------


@query(
    "s01_document_source",
    """SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
    FROM events WHERE event_type <> 'error'""",
)
def document_source(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON documents, some without ``props``; the presence rule reads the nested field."""
    props = F.when(F.col("event_type") != "error", F.from_json("props", "k bigint")).alias("props")
    lines = I.table(spark, sf, "events").select("event_id", "user_id", "value", props)
    path = new_dir(spark, "documents")
    lines.write.json(path)
    schema = "event_id bigint, user_id bigint, props struct<k:bigint>"
    return documents.read_documents(spark, path, schema, "props.k", ["event_id", "user_id", "props.k"])


@query("s06_table_overwrite", "SELECT p_partkey, p_name, p_brand FROM part")
def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "overwrite")
    parts = I.table(spark, sf, "part")
    tables.overwrite_table(parts.select("p_partkey", "p_type"), path)
    return tables.read_table(spark, tables.overwrite_table(parts.select("p_partkey", "p_name", "p_brand"), path))


@query(
    "s07_append_evolve",
    """SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""",
)
def append_evolve(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "append")
    orders = I.table(spark, sf, "orders")
    finished = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    others = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    tables.append_evolving(finished, path)
    return tables.read_table(spark, tables.append_evolving(others, path), evolve=True)


@query(
    "s08_replace_slice",
    f"""WITH {O.EAV}, {O.ERP_STRING}
    SELECT origem, sku, nome_produto, atributo, valor FROM eav
    UNION ALL SELECT origem, sku, nome_produto, atributo, valor FROM erp_string""",
)
def replace_slice(spark: SparkSession, sf: str) -> DataFrame:
    """First load of two sources, then a reload of one; the other slice stays."""
    path = new_dir(spark, "slices")
    erp = _erp_frames(spark, sf)["string"]
    stale = erp.withColumns({"origem": F.lit(ORIGIN), "valor": F.lit("antigo")})
    tables.replace_slice(erp.unionByName(stale), path)
    tables.replace_slice(_eav(spark, sf), path)
    return tables.read_table(spark, path).select("origem", "sku", "nome_produto", "atributo", "valor")


@query(
    "s08_empty_reload",
    f"""WITH {O.ERP_STRING} SELECT origem, sku, nome_produto, atributo, valor FROM erp_string""",
)
def empty_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources are loaded; a reload of the first finds nothing, so only its slice goes."""
    root = new_dir(spark, "snapshot")
    store, erp = _eav(spark, sf), _erp_frames(spark, sf)["string"]
    snapshots.publish_slices(spark, root, {"atributo_string": store.unionByName(erp)})
    snapshots.publish_slices(spark, root, {"atributo_string": store.where("sku IS NULL")}, slices=[ORIGIN])
    return snapshots.read_snapshot(spark, root, "atributo_string").drop("data_ingestao")


@query(
    "s10_upsert_all",
    f"""WITH {O.ORDERS} SELECT coalesce(n.sku, a.sku) AS sku, coalesce(n.status, a.status) AS status,
    coalesce(n.prioridade, a.prioridade) AS prioridade, coalesce(n.valor, a.valor) AS valor
    FROM alvo a FULL JOIN novo n ON a.sku = n.sku AND a.status = n.status""",
)
def upsert_all(spark: SparkSession, sf: str) -> DataFrame:
    target = I.order_target(spark, sf).drop("created_at", "updated_at")
    return sync.upsert_all(target, I.order_stage(spark, sf), ["sku", "status"])


_MERGED_ORDERS = f"""WITH {O.ORDERS} SELECT coalesce(n.sku, a.sku) AS sku, coalesce(n.status, a.status) AS status,
    coalesce(n.prioridade, a.prioridade) AS prioridade, coalesce(n.valor, a.valor) AS valor
    FROM alvo a FULL JOIN novo n ON a.sku = n.sku AND a.status = n.status"""


@query("s10_bucket_merge", _MERGED_ORDERS)
def bucket_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert into a table of key buckets, of which only the touched ones are rewritten."""
    root = new_dir(spark, "buckets")
    target = I.order_target(spark, sf).drop("created_at", "updated_at")
    merge.create_buckets(target, root, "pedidos", ["sku", "status"], buckets=16)
    merge.merge_buckets(spark, root, "pedidos", I.order_stage(spark, sf))
    return snapshots.read_snapshot(spark, root, "pedidos")


_SHOP = """SELECT CAST(p_partkey AS VARCHAR) AS sku, CASE WHEN p_size = 7 THEN NULL WHEN p_type = 'PROMO'
    THEN 'https://loja.example/v2/' || p_partkey ELSE 'https://loja.example/v1/' || p_partkey END AS url_loja
    FROM part"""


@query("s11_update_matched", _SHOP)
def update_matched(spark: SparkSession, sf: str) -> DataFrame:
    """Shop urls by parent reference; promoted parts have two, of which the larger wins."""
    none = F.lit(None).cast("string")
    target = I.table(spark, sf, "part").select(I.text("p_partkey").alias("sku"), none.alias("url_loja"))
    return sync.update_shop_urls(target, I.shop_skus(spark, sf), K.PARENT_REFERENCE_SUFFIX, "url_loja")


@query("s11_bucket_update", _SHOP)
def bucket_update(spark: SparkSession, sf: str) -> DataFrame:
    """The same shop urls in a table of key buckets; parents' references lose their suffix first."""
    root = new_dir(spark, "buckets")
    none = F.lit(None).cast("string")
    target = I.table(spark, sf, "part").select(I.text("p_partkey").alias("sku"), none.alias("url_loja"))
    merge.create_buckets(target, root, "produtos", ["sku"], buckets=16)
    urls = sync.shop_urls(I.shop_skus(spark, sf), K.PARENT_REFERENCE_SUFFIX, "url_loja")
    merge.update_buckets(spark, root, "produtos", urls, "sku", "url_loja")
    return snapshots.read_snapshot(spark, root, "produtos")


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = sync.sync_changes(I.order_target(spark, sf), I.order_stage(spark, sf), ["sku"], I.load_time())
    return changes.withColumns({c: F.col(c).cast("string") for c in ("created_at", "updated_at")})


@query("s12_sync_changes", f"WITH {O.CHANGES} SELECT * FROM mudancas")
def sync_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _changes(spark, sf)


@query(
    "s12_sync_apply",
    f"""WITH {O.CHANGES} SELECT sku, status, prioridade, valor, created_at, updated_at
    FROM mudancas WHERE op <> 'D'""",
)
def sync_apply(spark: SparkSession, sf: str) -> DataFrame:
    return sync.sync_apply(_changes(spark, sf))


_IMAGES = """img AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sku, CAST(l_partkey AS VARCHAR) AS id_arquivo,
    l_returnflag AS tipo_imagem, CAST(l_linenumber AS VARCHAR) AS nome_arquivo,
    CAST(l_suppkey AS VARCHAR) AS id, l_linestatus AS estado, l_shipdate
  FROM lineitem),
ialvo AS (SELECT * FROM img WHERE l_shipdate < TIMESTAMP '2000-01-01'),
inovo AS (SELECT * FROM img WHERE l_shipdate >= TIMESTAMP '1997-01-01')"""


@query(
    "s12_sync_images",
    f"""WITH {_IMAGES}
    SELECT CASE WHEN a.sku NOT IN (SELECT sku FROM inovo) THEN 'D'
      WHEN n.sku IS NOT NULL THEN 'U' ELSE '=' END AS op,
      a.sku, a.id_arquivo, a.tipo_imagem, a.nome_arquivo, a.id, coalesce(n.estado, 'OLD') AS estado
    FROM ialvo a LEFT JOIN (SELECT sku, id_arquivo, tipo_imagem, nome_arquivo, id, max(estado) AS estado
      FROM inovo GROUP BY 1, 2, 3, 4, 5) n
      ON n.sku = a.sku AND n.id_arquivo = a.id_arquivo AND n.tipo_imagem = a.tipo_imagem
      AND n.nome_arquivo = a.nome_arquivo AND n.id = a.id
    UNION ALL
    SELECT DISTINCT 'I', sku, id_arquivo, tipo_imagem, nome_arquivo, id, estado FROM inovo
    WHERE sku NOT IN (SELECT sku FROM ialvo)""",
)
def sync_images(spark: SparkSession, sf: str) -> DataFrame:
    return sync.sync_by_owner(I.image_target(spark, sf), I.image_stage(spark, sf), "sku", I.IMAGE_KEYS)


@query(
    "s13_link_rebuild",
    """SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS produto_imagem_id, o_custkey AS produto_id
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE NOT EXISTS (SELECT 1 FROM lineitem x JOIN orders y ON y.o_orderkey = x.l_orderkey
      WHERE x.l_suppkey = lineitem.l_suppkey AND y.o_custkey = orders.o_custkey AND y.o_orderstatus = 'F')""",
)
def link_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier images and customer products meet on the order; finished orders are linked already."""
    orders = I.table(spark, sf, "orders")
    images = I.table(spark, sf, "lineitem").select(
        I.text("l_orderkey").alias("sku"),
        I.text("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("nome_arquivo"),
    )
    owners = orders.select(I.text("o_orderkey").alias("sku"), F.col("o_custkey").alias("id"))
    finished = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("produto_id"))
    linked = (
        I.table(spark, sf, "lineitem")
        .join(finished, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(I.text("l_suppkey").alias("produto_imagem_id"), "produto_id")
    )
    return sync.link_rebuild(images, owners, linked)


@query(
    "s14_typed_publish",
    f"""WITH {O.WIDE} SELECT sku, coalesce(p_type, tipo) AS tipo_produto, tamanho AS tamanho_produto,
    CAST(TRY_CAST(preco AS DECIMAL(18,2)) AS DOUBLE) AS preco, retorno AS indicador_retorno,
    status_exib_site, CAST(p_size AS DOUBLE) AS tamanho_erp FROM wide""",
)
def typed_publish(spark: SparkSession, sf: str) -> DataFrame:
    """The wide products as the site receives them; decimals are shown as doubles for comparison."""
    spec = control.spec_rows(_spec(spark))
    requested = [source for source, *_ in spec if source]
    published = publish.typed_publish(eav.wide_product(_eav_tables(spark, sf), requested), spec)
    return published.withColumns({c: F.col(c).cast("double") for c in ("preco", "tamanho_erp")})


@query(
    "s15_brand_view",
    """SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS nome, p_type AS tipo, p_size AS tamanho
    FROM part WHERE lower(p_brand) = 'brand#2'""",
)
def brand_view(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.table(spark, sf, "part").select(
        I.text("p_partkey").alias("sku"),
        F.col("p_name").alias("nome"),
        F.col("p_brand").alias("marca"),
        F.col("p_type").alias("tipo"),
        F.col("p_size").alias("tamanho"),
        F.col("p_retailprice").alias("preco"),
    )
    view = tables.brand_view(parts, "Brand#2", parts.columns, ["sku", "nome"], fixed=("preco",))
    return tables.publish_view(view, "produtos_marca")


@query(
    "s16_tables_by_name",
    f"""WITH {O.ERP_STRING} SELECT sku, atributo, valor FROM erp_string
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_size', CAST(p_size AS VARCHAR) FROM part""",
)
def tables_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """EAV tables found in the catalog by name, link tables excepted, stacked as text."""
    frames = _erp_frames(spark, sf)
    for family in ("string", "bigint"):
        frames[family].createOrReplaceTempView(eav.table_name(family))
    frames["string"].createOrReplaceTempView("atributo_link")
    names = tables.tables_like(spark, "atributo_*", exclude="*_link*")
    return eav.stack_eav([spark.table(n) for n in names]).select("sku", "atributo", "valor")


# --- attribute store --------------------------------------------------------------------------


def _eav(spark: SparkSession, sf: str) -> DataFrame:
    return eav.eav_build(I.products(spark, sf), I.input_filter(spark), ORIGIN, I.load_time())


def _erp_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return eav.unpivot_by_family(I.table(spark, sf, "part"), "p_partkey", "part", I.load_time())


def _eav_tables(spark: SparkSession, sf: str) -> list[DataFrame]:
    erp = _erp_frames(spark, sf)
    return [_eav(spark, sf), erp["string"], erp["bigint"]]


def _spec(spark: SparkSession) -> DataFrame:
    return control.output_spec(
        I.input_filter(spark), I.catalogue(spark), I.output_filter(spark), I.DESTINATION
    )


_WIDE_ATTRIBUTES = ["TIPO", "Tamanho", "preco", "retorno", "status_exib_site", "p_type", "p_size"]


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return eav.wide_product(_eav_tables(spark, sf), _WIDE_ATTRIBUTES)


@query("d01_eav_build", f"WITH {O.EAV} SELECT * FROM eav")
def eav_build(spark: SparkSession, sf: str) -> DataFrame:
    return _eav(spark, sf).drop("data_ingestao")


@query("d10_unpivot_string", f"WITH {O.ERP_STRING} SELECT * FROM erp_string")
def unpivot_string(spark: SparkSession, sf: str) -> DataFrame:
    return _erp_frames(spark, sf)["string"].drop("data_ingestao")


@query(
    "d10_unpivot_bigint",
    """SELECT 'part' AS origem, CAST(p_partkey AS VARCHAR) AS sku, '' AS nome_produto, 'p_size' AS atributo,
    CAST(p_size AS BIGINT) AS valor FROM part""",
)
def unpivot_bigint(spark: SparkSession, sf: str) -> DataFrame:
    return _erp_frames(spark, sf)["bigint"].drop("data_ingestao")


@query(
    "d10_unpivot_decimal",
    """SELECT 'part' AS origem, CAST(p_partkey AS VARCHAR) AS sku, a.atributo, a.valor
    FROM part, LATERAL (
      SELECT 'preco' AS atributo,
        CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,15)) AS VARCHAR) AS valor
      UNION ALL SELECT 'medida', CAST(p_partkey AS VARCHAR) || '.123456789012345') a""",
)
def unpivot_decimal(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_retailprice").cast("decimal(18,2)").alias("preco"),
        F.concat(I.text("p_partkey"), F.lit(".123456789012345")).cast("decimal(30,15)").alias("medida"),
    )
    long = eav.unpivot_by_family(parts, "p_partkey", "part", I.load_time())["decimal"]
    return long.select("origem", "sku", "atributo", F.col("valor").cast("string").alias("valor"))


@query(
    "d10_unpivot_float",
    """SELECT 'part' AS origem, CAST(p_partkey AS VARCHAR) AS sku, '' AS nome_produto,
    'p_retailprice' AS atributo, p_retailprice AS valor FROM part""",
)
def unpivot_float(spark: SparkSession, sf: str) -> DataFrame:
    return _erp_frames(spark, sf)["float"].drop("data_ingestao")


@query(
    "d10_publish_families",
    """SELECT 'part' AS origem, CAST(p_partkey AS VARCHAR) AS sku, a.tabela, a.atributo, a.valor
    FROM part, LATERAL (
      SELECT 'atributo_string' AS tabela, 'p_name' AS atributo, p_name AS valor
      UNION ALL SELECT 'atributo_string', 'p_brand', p_brand UNION ALL SELECT 'atributo_string', 'p_type', p_type
      UNION ALL SELECT 'atributo_bigint', 'p_size', CAST(p_size AS VARCHAR)
      UNION ALL SELECT 'atributo_float', 'p_retailprice', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)) a
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), b.tabela, b.atributo, b.valor
    FROM supplier, LATERAL (
      SELECT 'atributo_string' AS tabela, 's_name' AS atributo, s_name AS valor
      UNION ALL SELECT 'atributo_bigint', 's_nationkey', CAST(s_nationkey AS VARCHAR)) b""",
)
def publish_families(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources in the typed tables; the second is reloaded without one of its columns."""
    root = new_dir(spark, "snapshot")
    suppliers = I.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    eav.publish_families(suppliers, "s_suppkey", "supplier", I.load_time(), root)
    written = eav.publish_families(I.table(spark, sf, "part"), "p_partkey", "part", I.load_time(), root)
    eav.publish_families(suppliers.drop("s_acctbal"), "s_suppkey", "supplier", I.load_time(), root)
    found = snapshots.current(spark, root)
    frames = []
    for name in written:
        kind = "decimal(18,2)" if name == eav.table_name("float") else "string"
        rows = snapshots.read_parts(spark, found, name).withColumn("valor", F.col("valor").cast(kind).cast("string"))
        frames.append(rows.select("origem", "sku", F.lit(name).alias("tabela"), "atributo", "valor"))
    return tables.union_tables(frames)


@query("d11_wide_product", f"WITH {O.WIDE} SELECT * FROM wide")
def wide_product(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf)


@query(
    "d11_wide_many",
    """SELECT CAST(l_suppkey AS VARCHAR) AS sku, 'peca_' || CAST(l_partkey % 400 AS VARCHAR) AS atributo,
    max(CAST(l_quantity AS BIGINT)) AS valor FROM lineitem GROUP BY 1, 2""",
)
def wide_many(spark: SparkSession, sf: str) -> DataFrame:
    """A pivot to some hundred columns, named by the definition table, shown as its filled cells."""
    names = [r.atributo for r in I.table(spark, sf, "part").select(
        F.concat(F.lit("peca_"), (F.col("p_partkey") % 400).cast("string")).alias("atributo")
    ).distinct().orderBy("atributo").collect()]
    store = I.table(spark, sf, "lineitem").select(
        I.text("l_suppkey").alias("sku"),
        F.concat(F.lit("peca_"), (F.col("l_partkey") % 400).cast("string")).alias("atributo"),
        F.col("l_quantity").cast("bigint").alias("valor"),
    )
    cells = _cells(eav.wide_product([store], names), ["sku"])
    return cells.withColumn("valor", F.col("valor").cast("bigint"))


@query(
    "d12_unit_split",
    f"""WITH {O.WIDE} SELECT sku, tipo, split_part(tamanho, ' ', 1) AS tamanho,
    CASE WHEN tamanho LIKE '% %' THEN split_part(tamanho, ' ', 2) END AS tamanho_unid,
    preco, retorno, status_exib_site, p_type, p_size FROM wide""",
)
def unit_split(spark: SparkSession, sf: str) -> DataFrame:
    return eav.unit_split(_wide(spark, sf), eav.unit_attributes(I.products(spark, sf)))


# --- assets -----------------------------------------------------------------------------------

def _cells(wide, keys: list[str]):
    """The filled cells of a wide table, one row each, whatever its columns are called."""
    names = [c for c in wide.columns if c not in keys]
    return wide.unpivot(keys, [F.col(f"`{c}`") for c in names], "atributo", "valor").where(
        F.col("valor").isNotNull()
    )


@query(
    "d02_document_assets",
    f"""WITH {O.PAGES} SELECT sku, brand AS marca, 'documento' AS tipo_arquivo,
    nome AS nome_arquivo_documento, 'Tipo ' || type_id AS descricao, url, 'v' || lang AS versao,
    max(host) AS arquivo_host, max(lang) AS arquivo_idioma
    FROM pg GROUP BY 1, 2, 3, 4, 5, 6, 7""",
)
def document_assets(spark: SparkSession, sf: str) -> DataFrame:
    wide = assets.document_assets(I.document_products(spark, sf), I.input_filter(spark))
    return publish.rename_by_map(wide, control.rename_map(I.input_filter(spark)))


@query(
    "d03_image_assets",
    f"""WITH {O.PAGES}, attrs AS (
      SELECT *, 'Host' AS nome_atributo, host AS arquivo_host, NULL AS arquivo_idioma FROM pg
      UNION ALL SELECT *, CASE WHEN lang <> 'fr' THEN 'Idioma' END, NULL, lang FROM pg)
    SELECT sku, brand AS marca, host AS sub_marca, 'Produto' AS nome,
    split_part(type_id, '-', 2) AS tipo_imagem, 'images' AS tipo_arquivo,
    ' D' || page_id AS id_arquivo, nome AS nome_arquivo_imagem,
    '[' || page_url || '/1],[' || page_url || '/2],[' || page_url || '/3],[' || page_url || '/4],[' ||
      page_url || '/5]' AS resize,
    nome_atributo, CAST(NULL AS VARCHAR) AS unidade_medida,
    max(arquivo_host) AS arquivo_host, max(arquivo_idioma) AS arquivo_idioma
    FROM attrs GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11""",
)
def image_assets(spark: SparkSession, sf: str) -> DataFrame:
    wide = assets.image_assets(I.image_products(spark, sf), I.input_filter(spark))
    named = publish.rename_by_map(wide, control.rename_map(I.input_filter(spark)))
    return named.withColumn("resize", F.array_join("resize", ","))


_DOCUMENT_KEYS = "sku marca tipo_arquivo nome_arquivo_documento descricao url versao".split()


@query(
    "d02_document_cells",
    f"""WITH {O.PAGES} SELECT sku, brand AS marca, 'documento' AS tipo_arquivo,
    nome AS nome_arquivo_documento, 'Tipo ' || type_id AS descricao, url, 'v' || lang AS versao,
    a.atributo, max(a.valor) AS valor
    FROM pg, LATERAL (SELECT 'asset.host' AS atributo, host AS valor UNION ALL SELECT 'asset.lang', lang) a
    WHERE a.valor IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
)
def document_cells(spark: SparkSession, sf: str) -> DataFrame:
    wide = assets.document_assets(I.document_products(spark, sf), I.input_filter(spark))
    return _cells(wide, _DOCUMENT_KEYS)


@query(
    "d24_image_sizes",
    f"""WITH {O.PAGES} SELECT sku, ' D' || page_id AS id_arquivo, page_url || '/1' AS tamanho_g,
    page_url || '/2' AS tamanho_m, page_url || '/3' AS tamanho_p, page_url || '/4' AS tamanho_sqr_1_k,
    page_url || '/5' AS tamanho_gg, CAST(NULL AS VARCHAR) AS tamanho_ggg FROM pg""",
)
def image_sizes(spark: SparkSession, sf: str) -> DataFrame:
    images = I.image_products(spark, sf).select("sku", F.inline("assets.images"))
    return assets.image_sizes(images.select("sku", F.col("id").alias("id_arquivo"), "resize"))


_DOCS = """docs AS (SELECT sku, brand, max(CASE WHEN type_id = 'DOC-manual' THEN url END) AS "doc-manual",
      max(CASE WHEN type_id = 'DOC-ficha' THEN url END) AS "doc-ficha",
      max(CASE WHEN type_id = 'DOC-cad' THEN url END) AS "doc-cad" FROM pg GROUP BY sku, brand)"""


@query(
    "d25_documents_by_type",
    f"""WITH {O.PAGES}, produtos AS (SELECT sku, max(page_url) AS pagina FROM pg GROUP BY sku), {_DOCS}
    SELECT DISTINCT p.sku, pagina, 'documento' AS tipo_arquivo, "doc-manual", "doc-ficha", "doc-cad"
    FROM produtos p LEFT JOIN docs d ON d.sku = p.sku""",
)
def documents_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return assets.documents_by_type(I.page_products(spark, sf), I.document_products(spark, sf))


@query(
    "d25_document_type_cells",
    f"""WITH {O.PAGES}, produtos AS (SELECT sku, max(page_url) AS pagina FROM pg GROUP BY sku), docs AS (
      SELECT sku, brand, lower(type_id) AS atributo, max(url) AS valor FROM pg GROUP BY 1, 2, 3)
    SELECT DISTINCT p.sku, pagina, atributo, valor
    FROM produtos p JOIN docs d ON d.sku = p.sku WHERE valor IS NOT NULL""",
)
def document_type_cells(spark: SparkSession, sf: str) -> DataFrame:
    wide = assets.documents_by_type(I.page_products(spark, sf), I.document_products(spark, sf))
    return _cells(wide, ["sku", "pagina", "tipo_arquivo"]).drop("tipo_arquivo").distinct()


# --- hierarchy and references -----------------------------------------------------------------

_DEEPEST = "path[len(path)]"
_MARKETING = "['MKT', p_type, p_brand][p_size % 3 + 1]"
_WEBSITE = "['WEB', p_brand, p_type][p_size % 3 + 1]"


@query(
    "d04_hierarchy_dim",
    f"""WITH {O.PATHS} SELECT DISTINCT array_to_string(path, '/') AS hierarquia,
    'Água ' || {_DEEPEST} AS descricao, 'Casa' AS marca, path[1] AS nivel0, coalesce(path[2], '') AS nivel1,
    coalesce(path[3], '') AS nivel2, coalesce(path[4], '') AS nivel3, coalesce(path[5], '') AS nivel4
    FROM paths""",
)
def hierarchy_dim(spark: SparkSession, sf: str) -> DataFrame:
    nodes = I.hierarchy_nodes(spark, sf)
    return hierarchy.hierarchy_dim(nodes, I.load_time()).drop("data_ingestao")


@query(
    "d05_deepest_level",
    f"WITH {O.PATHS} SELECT DISTINCT sku, brand, {_DEEPEST} AS hierarquia_primaria FROM paths WHERE p_size <> 13",
)
def deepest_level(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.deepest_nodes(I.primary_paths(spark, sf), "hierarchies.primary", "hierarquia_primaria")


@query(
    "d06_hierarchy_link",
    f"""WITH {O.PATHS} SELECT sku,
    coalesce(CASE WHEN p_size <> 13 THEN brand END,
      CASE WHEN p_type IN ('PROMO','LARGE','SMALL') THEN p_brand END,
      CASE WHEN p_type IN ('PROMO','STANDARD') THEN brand END) AS marca,
    CASE WHEN p_size <> 13 THEN {_DEEPEST} END AS hierarquia_primaria,
    CASE WHEN p_type IN ('PROMO','LARGE','SMALL') THEN {_MARKETING} END AS hierarquia_marketing,
    CASE WHEN p_type IN ('PROMO','STANDARD') THEN {_WEBSITE} END AS hierarquia_website,
    'catalogo' AS origem
    FROM paths WHERE p_size <> 13 OR p_type IN ('PROMO','LARGE','SMALL','STANDARD')""",
)
def hierarchy_link(spark: SparkSession, sf: str) -> DataFrame:
    links = hierarchy.hierarchy_link(
        I.primary_paths(spark, sf), I.marketing_paths(spark, sf), I.website_paths(spark, sf), ORIGIN, I.load_time()
    )
    return links.drop("data_ingestao")


@query(
    "d07_site_paths",
    f"""WITH {O.PATHS} SELECT sku, 2 AS idx, {_DEEPEST} AS hierarquia FROM paths
    WHERE p_type IN ('PROMO','LARGE','MEDIUM') AND len(path) > 1
    UNION ALL SELECT sku, 0, {_DEEPEST} FROM paths WHERE p_type NOT IN ('PROMO','LARGE','MEDIUM')""",
)
def site_paths(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.site_paths(I.site_documents(spark, sf))


@query(
    "d07_on_site",
    f"""WITH {O.EAV}, {O.PATHS} SELECT sku, valor AS status_exib_site FROM eav
    WHERE lower(atributo) = 'status_exib_site' AND lower(trim(valor)) = 'sim'
    AND sku IN (SELECT sku FROM paths WHERE len(path) > 1)""",
)
def on_site(spark: SparkSession, sf: str) -> DataFrame:
    """Products shown on the site whose node has a first and a second level."""
    flags = _eav(spark, sf).where(F.lower("atributo") == K.SITE_FLAG_ATTRIBUTE)
    products = flags.select("sku", F.col("valor").alias(K.SITE_FLAG_ATTRIBUTE))
    dim = hierarchy.hierarchy_dim(I.hierarchy_nodes(spark, sf), I.load_time())
    placed = dim.where(F.col("nivel1") != "")
    return hierarchy.on_site(products, I.site_links(spark, sf), placed)


_REFERENCES = """SELECT coalesce(r.sku, i.sku) AS sku, r."relatedItems", i."installationItems" FROM (
      SELECT CAST(l_orderkey AS VARCHAR) AS sku, string_agg(CAST(l_partkey AS VARCHAR), ';'
        ORDER BY CAST(l_partkey AS VARCHAR)) AS "relatedItems" FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r
    FULL JOIN (
      SELECT CAST(l_orderkey AS VARCHAR) AS sku, string_agg(CAST(l_partkey AS VARCHAR), ';'
        ORDER BY CAST(l_partkey AS VARCHAR)) AS "installationItems" FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) i
    ON i.sku = r.sku"""


@query("d08_reference_lists", _REFERENCES)
def reference_lists(spark: SparkSession, sf: str) -> DataFrame:
    related = I.reference_products(spark, sf, "R", "relatedItems")
    installation = I.reference_products(spark, sf, "N", "installationItems")
    return references.reference_lists(related, installation)


# --- classification ---------------------------------------------------------------------------


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classification.classification(
        I.erp_materials(spark, sf),
        I.erp_objects(spark, sf),
        I.erp_values(spark, sf),
        I.erp_characteristics(spark, sf),
    )


@query("d09_classification", f"WITH {O.CLASSIFIED} SELECT * FROM classified")
def classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf)


@query(
    "d09_classification_cells",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS sku, '001' AS tipo_classe,
    'char_' || CAST(l_linenumber AS VARCHAR) AS atributo, max({O.LINE_VALUE}) AS valor
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, l_linenumber""",
)
def classification_cells(spark: SparkSession, sf: str) -> DataFrame:
    keys = list(classification.MATERIAL_KEYS)
    return _cells(_classified(spark, sf), keys).select("sku", "tipo_classe", "atributo", "valor")


@query(
    "d09_classified_values",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS sku, '789' || CAST(p_partkey AS VARCHAR) AS codigo_barras,
    {O.SECTOR} AS setor_atividade, CAST(l_linenumber AS VARCHAR) AS caracteristica, '001' AS tipo_classe,
    'UN' AS unidade_medida_basica, p_brand || '-' || p_type AS prdha,
    'char_' || CAST(l_linenumber AS VARCHAR) AS atributo, CAST(p_size AS VARCHAR) AS formato,
    {O.LINE_VALUE} AS valor,
    CASE WHEN l_returnflag = 'A' THEN 'Descrição A' ELSE {O.LINE_VALUE} END AS caracteristica_interna
    FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def classified_values(spark: SparkSession, sf: str) -> DataFrame:
    return classification.classified_values(
        I.erp_materials(spark, sf),
        I.erp_objects(spark, sf),
        I.erp_values(spark, sf),
        I.erp_characteristics(spark, sf),
        I.erp_codes(spark, sf),
        I.erp_code_texts(spark, sf),
    )


_COMMERCIAL = classification.CommercialRules(
    line=("char_1", "char_2"),
    pattern=("char_3",),
    environment=("char_4", "char_5"),
    converter="char_6",
    product_columns=("categoria",),
)


@query(
    "d16_commercial_view",
    f"""WITH {O.CLASSIFIED}, produto AS (
      SELECT CAST(p_partkey AS VARCHAR) AS sku, {O.BRAND} AS marca,
        coalesce(CASE WHEN p_size > 40 THEN 'ATIVO' END, 'SAP') AS status_venda,
        CASE WHEN p_size > 35 THEN p_name END AS padrao, CAST(NULL AS VARCHAR) AS ambiente, p_type AS categoria
      FROM part WHERE p_size > 25)
    SELECT m.sku, m.codigo_barras, coalesce(p.marca, m.setor_atividade) AS marca, p.status_venda,
      left(m.prdha, 3) AS codigo_tamanho, left(m.prdha, 8) AS segmento, coalesce(char_1, char_2) AS linha_2,
      coalesce(p.padrao, char_3) AS padrao, coalesce(p.ambiente, char_4, char_5) AS ambiente,
      char_6 AS conversor, m.unidade_medida_basica, m.prdha AS codigo_hierarquia, p.categoria
    FROM classified m LEFT JOIN produto p ON p.sku = m.sku
    WHERE m.setor_atividade IN {K.COMMERCIAL_SECTORS}""",
)
def commercial_view(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    products = I.table(spark, sf, "part").where(size > 25).select(
        I.text("p_partkey").alias("sku"),
        I.part_brand().alias("marca"),
        F.when(size > 40, "ATIVO").alias("status_venda"),
        F.lit("SAP").alias("status_venda_sap"),
        F.when(size > 35, F.col("p_name")).alias("padrao"),
        F.lit(None).cast("string").alias("ambiente"),
        F.col("p_type").alias("categoria"),
    )
    return classification.commercial_view(products, _classified(spark, sf), _COMMERCIAL)


# --- publishing -------------------------------------------------------------------------------

_BASE_URL = "https://site.example/ambientes/"


def _slug_sql(level: int) -> str:
    own, above = f"coalesce(path[{level + 1}], '')", f"coalesce(path[{level}], '')"
    description = f"replace('Água ' || {_DEEPEST}, ' ', '-') || '/'"
    skip = f"WHEN {above} = '' THEN ''" if level > 1 else ""
    return f"CASE WHEN trim({own}) <> '' THEN replace({own}, ' ', '-') || '/' {skip} ELSE {description} END"


_URLS = f"""nomes AS (
      SELECT *, CASE WHEN p_type = 'PROMO' THEN ' Açaí "' || p_name || '" 1/2.5 ' ELSE p_name END AS nome FROM paths),
    urls AS (SELECT DISTINCT sku, replace(translate(lower('{_BASE_URL}' || {' || '.join(_slug_sql(i) for i in range(1, 5))} ||
      CASE WHEN p_type = 'SMALL' THEN 'Antigo-' || sku ELSE
        replace(regexp_replace(trim(nome), '["/.]', '', 'g'), ' ', '-') || replace(sku, '.', '')
      END), '{K.ACCENTED}', '{K.UNACCENTED}'), '"', '') AS url_catalogo_institucional,
      CASE WHEN p_type = 'SMALL' THEN p_name END AS palavra_chave,
      CASE WHEN p_type = 'SMALL' THEN p_brand END AS produto_relacionado,
      CAST(NULL AS VARCHAR) AS assinatura_arquiteto
    FROM nomes)"""


@query("d14_slug_url", f"WITH {O.PATHS}, {_URLS} SELECT * FROM urls")
def slug_url(spark: SparkSession, sf: str) -> DataFrame:
    dim = hierarchy.hierarchy_dim(I.hierarchy_nodes(spark, sf), I.load_time())
    return publish.institutional_urls(
        I.named_products(spark, sf), I.site_links(spark, sf), dim, I.url_history(spark, sf), _BASE_URL
    )


@query(
    "d13_site_products",
    f"""WITH {O.WIDE}, {O.PATHS}, {O.PAGES}, {_DOCS}, refs AS ({_REFERENCES}), {_URLS}, loja AS ({_SHOP})
    SELECT DISTINCT w.sku, coalesce(p_type, tipo) AS tipo_produto, tamanho AS tamanho_produto,
    CAST(TRY_CAST(preco AS DECIMAL(18,2)) AS DOUBLE) AS preco, retorno AS indicador_retorno,
    status_exib_site, CAST(w.p_size AS DOUBLE) AS tamanho_erp,
    CASE WHEN d.sku IS NOT NULL THEN 'documento' END AS tipo_arquivo, "doc-manual", "doc-ficha", "doc-cad",
    r."relatedItems", r."installationItems", u.url_catalogo_institucional, u.palavra_chave,
    u.produto_relacionado, u.assinatura_arquiteto, l.url_loja
    FROM wide w LEFT JOIN docs d ON d.sku = w.sku LEFT JOIN refs r ON r.sku = w.sku
    LEFT JOIN urls u ON u.sku = w.sku LEFT JOIN loja l ON l.sku = w.sku
    WHERE lower(trim(status_exib_site)) = 'sim' AND w.sku IN (SELECT sku FROM paths)""",
)
def site_products(spark: SparkSession, sf: str) -> DataFrame:
    """The published site table, from attribute store to urls; decimals shown as doubles."""
    dim = hierarchy.hierarchy_dim(I.hierarchy_nodes(spark, sf), I.load_time())
    inputs = site.SiteInputs(
        eav_tables=_eav_tables(spark, sf),
        names=I.named_products(spark, sf),
        documents=I.document_products(spark, sf),
        related=I.reference_products(spark, sf, "R", "relatedItems"),
        installation=I.reference_products(spark, sf, "N", "installationItems"),
        site_links=I.site_links(spark, sf),
        hierarchy=dim,
        history=I.url_history(spark, sf),
        shop=I.shop_skus(spark, sf),
    )
    published = site.site_products(inputs, control.spec_rows(_spec(spark)), _BASE_URL, "url_loja")
    return published.withColumns({c: F.col(c).cast("double") for c in ("preco", "tamanho_erp")})


_REFRESH_KEYS = ["sistema_origem", "tabela_origem", "id_atributo_entrada"]


@query(
    "d26_control_refresh",
    f"""SELECT 'erp' AS sistema_origem, 'part' AS tabela_origem,
      ' Attr_' || CAST(p_partkey AS VARCHAR) AS id_atributo_entrada,
      p_brand || '-' || p_type AS id_atributo_catalogo, CASE WHEN p_size > 10 THEN '1' ELSE '0' END AS ativo
    FROM part
    UNION ALL SELECT * FROM (VALUES {', '.join(str(r) for r in I.INPUT_ROWS)})
    UNION ALL SELECT 'erp', 'material', column_name, '', 'false'
    FROM (VALUES ('p_partkey'), ('p_name'), ('p_brand'), ('p_retailprice')) c(column_name)""",
)
def control_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Describe ``part`` into an input filter that also holds one entry per part."""
    described = control.schema_rows(I.table(spark, sf, "part"), "erp", "material", I.load_time())
    current = I.part_input_filter(spark, sf).unionByName(I.input_filter(spark))
    refreshed = sync.upsert_all(current, described, _REFRESH_KEYS, keep=("id_atributo_catalogo", "ativo"))
    return refreshed.drop("data_criacao")


@query(
    "d27_publish_projection",
    """SELECT CAST(p_partkey AS VARCHAR) AS sku, p_type AS categoria,
    upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
      upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS nome_portfolio,
    p_brand AS marca_loja, '' AS created_by_id, '' AS updated_by_id, '' AS sitemap_exclude FROM part""",
)
def publish_projection(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.table(spark, sf, "part").select(
        I.text("p_partkey").alias("sku"), F.col("p_type").alias("categoria"), "p_name", "p_brand"
    )
    published = publish.publish_projection(
        parts, ["sku", "categoria"], I.load_time(), {"nome_portfolio": "p_name"}, {"marca_loja": "p_brand"}
    )
    return published.drop("created_at", "updated_at", "id")


_AUDIT_SQL = "'' AS created_at, '' AS updated_at, '' AS created_by_id, '' AS updated_by_id, '' AS sitemap_exclude"


@query(
    "d27_hierarchy_stage",
    f"""WITH {O.PATHS}, dim AS (SELECT DISTINCT array_to_string(path, '/') AS hierarquia,
      'Água ' || {_DEEPEST} AS descricao, 'Casa' AS marca, path[1] AS nivel0, coalesce(path[2], '') AS nivel1,
      coalesce(path[3], '') AS nivel2, coalesce(path[4], '') AS nivel3, coalesce(path[5], '') AS nivel4 FROM paths)
    SELECT *, {_AUDIT_SQL}, row_number() OVER (ORDER BY hierarquia, descricao, marca, nivel0, nivel1, nivel2,
      nivel3, nivel4) AS id FROM dim""",
)
def hierarchy_stage(spark: SparkSession, sf: str) -> DataFrame:
    dim = hierarchy.hierarchy_dim(I.hierarchy_nodes(spark, sf), I.load_time()).drop("data_ingestao")
    return publish.publish_stage(dim, dim.columns, ["hierarquia"])


@query(
    "d27_image_stage",
    f"""WITH {O.PAGES}, img AS (SELECT DISTINCT sku, brand AS marca, host AS sub_marca, 'Produto' AS nome,
      split_part(type_id, '-', 2) AS tipo_imagem, 'images' AS tipo_arquivo, ' D' || page_id AS id_arquivo,
      nome AS nome_arquivo, '[' || page_url || '/1],[' || page_url || '/2],[' || page_url || '/3],[' ||
        page_url || '/4],[' || page_url || '/5]' AS tamanho FROM pg)
    SELECT *, {_AUDIT_SQL}, row_number() OVER (ORDER BY sku NULLS FIRST, marca NULLS FIRST, sub_marca NULLS FIRST,
      nome NULLS FIRST, tipo_imagem NULLS FIRST, tipo_arquivo NULLS FIRST, id_arquivo NULLS FIRST,
      nome_arquivo NULLS FIRST, tamanho NULLS FIRST) AS id FROM img""",
)
def image_stage(spark: SparkSession, sf: str) -> DataFrame:
    wide = assets.image_assets(I.image_products(spark, sf), I.input_filter(spark))
    named = wide.withColumns(
        {"tamanho": F.array_join("resize", ","), "nome_arquivo": F.col("nome_arquivo_imagem")}
    )
    columns = "sku marca sub_marca nome tipo_imagem tipo_arquivo id_arquivo nome_arquivo tamanho".split()
    return publish.publish_stage(named, columns, ["sku"])


# --- quality ----------------------------------------------------------------------------------


def _two_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, list[str]]:
    left, right = I.customer_left(spark, sf), I.customer_right(spark, sf)
    return left, right, quality.shared_columns(left, right, "sku")


@query(
    "d17_column_diff",
    f"""WITH {O.CUSTOMERS}, pares AS (
      SELECT e.sku, v.coluna, v.a, v.b FROM esq e JOIN dir d ON d.sku = e.sku, LATERAL (
        SELECT 'nome' AS coluna, e.nome AS a, d.nome AS b UNION ALL SELECT 'segmento', e.segmento, d.segmento
        UNION ALL SELECT 'nacao', e.nacao, d.nacao UNION ALL SELECT 'saldo', e.saldo, d.saldo) v)
    SELECT sku, coluna, trim(a) AS valor_site, trim(b) AS valor_catalogo FROM pares
    WHERE lower(trim(a)) IS DISTINCT FROM lower(trim(b))""",
)
def column_diff(spark: SparkSession, sf: str) -> DataFrame:
    left, right, columns = _two_sources(spark, sf)
    return quality.column_diff(left, right, "sku", columns)


@query(
    "d17_diff_matrix",
    f"""WITH {O.CUSTOMERS} SELECT e.sku,
    CASE WHEN e.segmento IS DISTINCT FROM d.segmento THEN coalesce(e.segmento, '') ELSE '' END AS site_segmento,
    CASE WHEN e.segmento IS DISTINCT FROM d.segmento THEN coalesce(d.segmento, '') ELSE '' END AS catalogo_segmento,
    CASE WHEN e.nacao IS DISTINCT FROM d.nacao THEN e.nacao ELSE '' END AS site_nacao,
    CASE WHEN e.nacao IS DISTINCT FROM d.nacao THEN d.nacao ELSE '' END AS catalogo_nacao
    FROM esq e JOIN dir d ON d.sku = e.sku""",
)
def diff_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Names agree after trimming and lower-casing and balances agree, so neither has a column."""
    left, right, columns = _two_sources(spark, sf)
    return quality.diff_matrix(left, right, "sku", columns, drop_equal=True)


def _side_sql(column: str) -> str:
    agree = f"lower(trim(coalesce(e.{column}, ''))) = lower(trim(coalesce(d.{column}, '')))"
    return f"e.{column} AS site_{column}, d.{column} AS catalogo_{column}, {agree} AS validar_{column}"


@query(
    "d18_side_by_side",
    f"""WITH {O.CUSTOMERS} SELECT e.sku, {', '.join(_side_sql(c) for c in ('nome', 'segmento', 'nacao', 'saldo'))}
    FROM esq e JOIN dir d ON d.sku = e.sku""",
)
def side_by_side(spark: SparkSession, sf: str) -> DataFrame:
    left, right, columns = _two_sources(spark, sf)
    return quality.side_by_side(left, right, "sku", columns)


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Completeness of the parts shown on the site.

    The attribute store is a table: it is built once, written, and then read for both the site
    flags and the values.
    """
    store = tables.write_version(_eav(spark, sf), "eav")
    stored = tables.read_table(spark, store)
    return completeness.completeness(I.primary_paths(spark, sf), I.rule_nodes(spark, sf), stored)


@query("d19_completeness", f"WITH {O.MATRIX} SELECT * FROM matriz")
def completeness_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return matrix(spark, sf)


@query(
    "d20_completeness_pct",
    f"""WITH {O.MATRIX}, c AS (SELECT obrigatorio, preenchido, count(*) AS contagem FROM matriz GROUP BY 1, 2),
    t AS (SELECT *, CAST(sum(contagem) OVER (PARTITION BY obrigatorio) AS BIGINT) AS total FROM c)
    SELECT obrigatorio, preenchido, contagem, total,
    CAST(CAST(CAST(contagem AS DOUBLE) / total AS DECIMAL(18,2)) * 100 AS DOUBLE) AS percentual FROM t""",
)
def completeness_share(spark: SparkSession, sf: str) -> DataFrame:
    share = completeness.completeness_share(matrix(spark, sf))
    return share.withColumn("percentual", F.col("percentual").cast("double"))


@query(
    "d21_completeness_by_sku",
    f"""WITH {O.MATRIX}, c AS (
      SELECT sku, obrigatorio, preenchido, count(*) AS contagem FROM matriz GROUP BY 1, 2, 3),
    t AS (SELECT *, CAST(sum(contagem) OVER (PARTITION BY sku, obrigatorio) AS BIGINT) AS total FROM c)
    SELECT sku, obrigatorio, preenchido, contagem, total,
    replace(CAST(CAST(CAST(contagem AS DOUBLE) / total * 100 AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS percentual
    FROM t""",
)
def completeness_by_sku(spark: SparkSession, sf: str) -> DataFrame:
    return completeness.completeness_by_sku(matrix(spark, sf))


_ALL_SHOWN = O.matrix_all("lower(valor) IN ('sim', 'nao')")


def _matrix_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Required and optional attributes of all parts that have a site flag, shown or not."""
    stored = tables.read_table(spark, tables.write_version(_eav(spark, sf), "eav"))
    return completeness.completeness_counts(
        I.primary_paths(spark, sf),
        I.rule_nodes(spark, sf),
        stored,
        site_rule=lambda value: F.lower(value).isin("sim", "nao"),
    )


@query(
    "d20_completeness_pct_all",
    f"""WITH {_ALL_SHOWN}, c AS (SELECT obrigatorio, preenchido, count(*) AS contagem FROM matriz GROUP BY 1, 2),
    t AS (SELECT *, CAST(sum(contagem) OVER (PARTITION BY obrigatorio) AS BIGINT) AS total FROM c)
    SELECT obrigatorio, preenchido, contagem, total,
    CAST(CAST(CAST(contagem AS DOUBLE) / total AS DECIMAL(18,2)) * 100 AS DOUBLE) AS percentual FROM t""",
)
def completeness_share_all(spark: SparkSession, sf: str) -> DataFrame:
    share = completeness.completeness_share(_matrix_counts(spark, sf))
    return share.withColumn("percentual", F.col("percentual").cast("double"))


@query(
    "d21_completeness_by_sku_all",
    f"""WITH {_ALL_SHOWN}, c AS (
      SELECT sku, obrigatorio, preenchido, count(*) AS contagem FROM matriz GROUP BY 1, 2, 3),
    t AS (SELECT *, CAST(sum(contagem) OVER (PARTITION BY sku, obrigatorio) AS BIGINT) AS total FROM c)
    SELECT sku, obrigatorio, preenchido, contagem, total,
    replace(CAST(CAST(CAST(contagem AS DOUBLE) / total * 100 AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS percentual
    FROM t""",
)
def completeness_by_sku_all(spark: SparkSession, sf: str) -> DataFrame:
    return completeness.completeness_by_sku(_matrix_counts(spark, sf))


_CLASSES = """SELECT DISTINCT 'attr_' || CAST(p_partkey AS VARCHAR) AS id_atributo_entrada,
    p_brand || '-' || p_type AS id_atributo_catalogo, c.classe
    FROM (SELECT p_partkey, p_brand, p_type,
      CASE p_type WHEN 'ECONOMY' THEN 'documento' WHEN 'LARGE' THEN 'documento;imagem'
        WHEN 'MEDIUM' THEN 'imagem' WHEN 'PROMO' THEN NULL ELSE 'produto' END AS tabela,
      CASE right(p_brand, 1) WHEN '1' THEN 'LOV' WHEN '2' THEN 'number' WHEN '3' THEN 'text' ELSE 'string' END
        AS tipo FROM part), LATERAL (
      SELECT 'documento' AS classe WHERE tabela IN ('documento', 'documento;imagem')
      UNION ALL SELECT 'imagem' WHERE tabela IN ('imagem', 'documento;imagem')
      UNION ALL SELECT 'golden_record' WHERE tabela NOT IN ('documento', 'documento;imagem')
      UNION ALL SELECT 'lov' WHERE tabela NOT IN ('documento', 'documento;imagem') AND tipo = 'LOV'
      UNION ALL SELECT 'text' WHERE tabela NOT IN ('documento', 'documento;imagem') AND tipo IN ('string', 'text')
      UNION ALL SELECT 'number' WHERE tabela NOT IN ('documento', 'documento;imagem') AND tipo = 'number') c"""


@query("d22_attr_classes", _CLASSES)
def attr_classes(spark: SparkSession, sf: str) -> DataFrame:
    return control.attribute_classes(I.part_input_filter(spark, sf), I.part_catalogue(spark, sf))


_INVALID = """SELECT DISTINCT brand, sku, lower(trim(id)) AS id_atributo_entrada, value AS valor
    FROM raw WHERE brand IS NOT NULL AND lower(trim(id)) IN ('preco', 'inativo', 'p_size')
    AND TRY_CAST(value AS DECIMAL(10,0)) IS NULL"""
_CHECKED = f"""{O.RAW}, {O.PAGES}, achados AS (
      SELECT sku, brand, nome, lang, page_id, url, 'documents' AS tipo FROM pg
      UNION ALL SELECT sku, brand, nome, lang, page_id, url, 'images' FROM pg)"""
_BLANK_NAMES = """SELECT DISTINCT 'nome_vazio' AS regra, 'golden_record.attributes' AS origem, brand AS marca,
      CAST(NULL AS VARCHAR) AS sku, lower(trim(id)) AS id, name AS valor
    FROM raw WHERE brand IS NOT NULL AND coalesce(trim(name), '') = '' AND lower(id) = 'tamanho'
    UNION ALL
    SELECT 'nome_vazio', 'golden_record.' || tipo, brand, sku, 'd' || page_id, nome FROM achados WHERE nome = ''
    UNION ALL
    SELECT 'nome_vazio', 'golden_record.' || tipo || '.attributes', brand, sku, 'asset.lang', NULL
    FROM achados WHERE lang = 'fr'"""
_BLANK_URLS = """SELECT 'url_vazia' AS regra, 'golden_record.' || tipo AS origem, brand AS marca, sku,
      'd' || page_id AS id, url AS valor FROM achados
    WHERE (brand IS NOT NULL AND url IS NULL) OR trim(url) = ''"""


def _class_ids(spark: SparkSession, name: str) -> DataFrame:
    return control.class_ids(I.input_filter(spark), I.catalogue(spark), name)


@query("d22_invalid_numbers", f"WITH {O.RAW} {_INVALID}")
def invalid_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return quality.invalid_numbers(I.products(spark, sf), _class_ids(spark, "number"))


@query("d22_blank_names", f"WITH {_CHECKED} {_BLANK_NAMES}")
def blank_names(spark: SparkSession, sf: str) -> DataFrame:
    return quality.blank_names(
        I.products(spark, sf),
        _class_ids(spark, "golden_record"),
        I.document_products(spark, sf),
        I.image_products(spark, sf),
    )


@query("d22_blank_urls", f"WITH {_CHECKED} {_BLANK_URLS}")
def blank_urls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.blank_urls(I.document_products(spark, sf), I.image_products(spark, sf))


@query(
    "d22_findings",
    f"""WITH {_CHECKED} {_BLANK_NAMES} UNION ALL {_BLANK_URLS} UNION ALL
    SELECT 'numero_invalido', 'golden_record.attributes', brand, sku, id_atributo_entrada, valor FROM ({_INVALID})""",
)
def findings(spark: SparkSession, sf: str) -> DataFrame:
    """All rules at once; each source is read once per shape of its rules."""
    return quality.findings(
        I.products(spark, sf),
        _class_ids(spark, "golden_record"),
        _class_ids(spark, "number"),
        I.document_products(spark, sf),
        I.image_products(spark, sf),
    )


@query(
    "d23_url_health",
    f"""WITH {O.PAGES}, alvos AS (
      SELECT 'golden_record.documents' AS origem, sku, trim(url) AS url FROM pg WHERE brand IS NOT NULL
      UNION SELECT 'golden_record.images', sku, trim(url) FROM pg WHERE brand IS NOT NULL
      UNION SELECT 'produto', sku, max(page_url) FROM pg GROUP BY sku),
    crawl AS (SELECT page_url AS url, CASE WHEN page_url LIKE '%#top' THEN -1
        WHEN page_url LIKE '%ref=x' THEN 503 WHEN page_url LIKE '%.html' THEN 404 ELSE 200 END AS status,
      CASE WHEN page_url LIKE '%utm_source%' THEN html || '{K.NOT_FOUND_PHRASE}' ELSE html END AS body FROM pg)
    SELECT a.origem, a.sku, a.url, c.status, CASE WHEN status > 200 THEN 'erro_http'
      WHEN status = -1 THEN 'sem_resposta' ELSE 'pagina_inexistente' END AS situacao
    FROM alvos a JOIN crawl c ON c.url = a.url
    WHERE status <> 200 OR contains(body, '{K.NOT_FOUND_PHRASE}')""",
)
def url_health(spark: SparkSession, sf: str) -> DataFrame:
    targets = quality.url_targets(
        I.document_products(spark, sf), I.image_products(spark, sf), I.page_products(spark, sf), "pagina"
    )
    return quality.url_health(targets, I.crawl_results(spark, sf))


_LOGGED = f"""{O.PAGES}, crawl AS (SELECT page_url AS url, page_id,
      CASE WHEN page_url LIKE '%#top' THEN -1 WHEN page_url LIKE '%ref=x' THEN 503
        WHEN page_url LIKE '%.html' THEN 404 ELSE 200 END AS status,
      CASE WHEN page_url LIKE '%utm_source%' THEN html || '{K.NOT_FOUND_PHRASE}' ELSE html END AS body FROM pg),
    julgados AS (SELECT trim(url) AS url, status, CASE WHEN status > 200 THEN 'erro_http'
        WHEN status = -1 THEN 'sem_resposta'
        WHEN status = 200 AND contains(body, '{K.NOT_FOUND_PHRASE}') THEN 'pagina_inexistente' END AS situacao
      FROM crawl),
    diario AS (
      SELECT url, max(struct_pack(a := status, b := coalesce(situacao, ''))) AS e, '2024-01-01 00:00:00' AS data_ingestao
      FROM julgados WHERE status <> 503 GROUP BY url
      UNION ALL SELECT url, max(struct_pack(a := 200, b := '')), '2024-02-01 00:00:00'
      FROM julgados WHERE status = 404 GROUP BY url)"""


def _url_log(spark: SparkSession, sf: str) -> DataFrame:
    """A first crawl without the overloaded pages, then a second one of pages that are back."""
    path = new_dir(spark, "urls")
    crawl = I.crawl_results(spark, sf)
    quality.append_url_log(crawl.where("status <> 503"), path, I.load_time())
    back = crawl.where("status = 404").withColumns({"status": F.lit(200), "body": F.lit("")})
    quality.append_url_log(back, path, F.lit("2024-02-01").cast("timestamp"))
    return tables.read_table(spark, path)


@query(
    "d23_append",
    f"""WITH {_LOGGED} SELECT url, CAST(e.a AS BIGINT) AS status, nullif(e.b, '') AS situacao, data_ingestao FROM diario""",
)
def url_log(spark: SparkSession, sf: str) -> DataFrame:
    log = _url_log(spark, sf)
    return log.withColumns({"status": F.col("status").cast("bigint"), "data_ingestao": F.col("data_ingestao").cast("string")})


@query(
    "d23_latest",
    f"""WITH {_LOGGED} SELECT url, CAST(arg_max(e.a, data_ingestao) AS BIGINT) AS status,
    nullif(arg_max(e.b, data_ingestao), '') AS situacao, max(data_ingestao) AS data_ingestao FROM diario GROUP BY url""",
)
def url_latest(spark: SparkSession, sf: str) -> DataFrame:
    latest = quality.latest_urls(_url_log(spark, sf))
    return latest.withColumns({"status": F.col("status").cast("bigint"), "data_ingestao": F.col("data_ingestao").cast("string")})


@query(
    "d23_due_urls",
    f"""WITH {_LOGGED} SELECT DISTINCT url FROM julgados WHERE url NOT IN
    (SELECT url FROM diario WHERE data_ingestao >= '2024-01-15 00:00:00')""",
)
def url_due(spark: SparkSession, sf: str) -> DataFrame:
    """Pages never crawled, and those not crawled since the middle of January."""
    pages = I.table(spark, sf, "pages").select("url")
    return quality.due_urls(pages, _url_log(spark, sf), F.lit("2024-01-15").cast("timestamp"))
