"""Catalogue inputs that Spark derives from the given tables.

All rows of the base tables are used. Nulls, blanks, bad values and missing sides follow from
business columns (size, type, status ...), so the derived data grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.constants import NOT_FOUND_PHRASE, PARENT_REFERENCE_SUFFIX
from skuloom.session import small_rows
from skuloom.sources.schemas import ATTRIBUTE_CATALOGUE, OUTPUT_FILTER

LOAD_TIME_TEXT = "2024-01-01 00:00:00"


def load_time() -> Column:
    """Fixed load time, so results repeat."""
    return F.lit(LOAD_TIME_TEXT).cast("timestamp")


# Declared schemas of the given tables: no job has to open files to infer them.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


# --- products with attributes -----------------------------------------------------------------


def part_brand() -> Column:
    return F.when(F.col("p_size") != 17, F.col("p_brand"))


def _value(value: Column, unit: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        value.alias("value"),
        none.alias("valueId"),
        none.alias("subValue"),
        (none if unit is None else unit).alias("uom"),
    )


def _attribute(identifier: str, name: Column, values: Column) -> Column:
    return F.struct(F.lit(identifier).alias("id"), name.alias("name"), values.alias("values"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as nested product documents; the return flags of a part are a multi-value."""
    size = F.col("p_size")
    flags = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.collect_set("l_returnflag").alias("flags"))
    )
    unit = F.when(size <= 20, F.lit("cm")).when(size <= 30, F.lit(" "))
    price = F.when(size == 23, F.lit("n/a")).otherwise(money("p_retailprice").cast("string"))
    attributes = F.array(
        _attribute("TIPO", F.lit("Tipo"), F.array(_value(F.when(size != 29, F.col("p_type"))))),
        _attribute(
            "Tamanho",
            F.when(size == 19, F.lit(" ")).otherwise(F.lit("Tamanho")),
            F.array(_value(text("p_size"), unit)),
        ),
        _attribute("PRECO", F.lit("Preço"), F.array(_value(price))),
        _attribute("RETORNO", F.lit("Retorno"), F.transform("flags", lambda f: _value(f))),
        _attribute("brand", F.lit("Marca"), F.array(_value(part_brand()))),
        _attribute("INATIVO", F.lit("Inativo"), F.array(_value(F.col("p_name")))),
        _attribute(
            "STATUS_EXIB_SITE",
            F.lit("Exibe"),
            F.array(_value(F.when(F.col("p_type") == "ECONOMY", "Nao").otherwise("Sim"))),
        ),
    )
    return (
        table(spark, sf_dir, "part")
        .join(flags, "p_partkey", "left")
        .select(
            text("p_partkey").alias("sku"),
            F.col("p_name").alias("name"),
            part_brand().alias("brand"),
            F.col("p_type").alias("subBrand"),
            F.lit("2024-01-01").alias("updateDate"),
            attributes.alias("attributes"),
        )
    )


# --- control tables ---------------------------------------------------------------------------

# Fixed values: (system, table, input id, catalogue id, active).
INPUT_ROWS = [
    ("catalogo", "atributos", "tipo", "Tipo_Produto", "1"),
    ("catalogo", "atributos", "TAMANHO", "tamanho", "true"),
    ("catalogo", "atributos", "preco", "preco", "Sim"),
    ("catalogo", "atributos", "retorno", "indicador", "1"),
    ("catalogo", "atributos", "brand", "marca_produto", "1"),
    ("catalogo", "atributos", "status_exib_site", "status_exib_site", "1"),
    ("catalogo", "atributos", "inativo", "preco", "0"),
    ("catalogo", "documentos", "asset.host", "arquivo_host", "1"),
    ("catalogo", "documentos", "asset.lang", "arquivo_idioma", "1"),
    ("erp", "material", "p_type", "tipo_produto", "1"),
    ("erp", "material", "p_size", "tamanho_erp", "1"),
]
# Fixed values: (catalogue id, data type, precision, description, table).
CATALOGUE_ROWS = [
    ("tipo_produto", "LOV", None, "Tipo do produto", "produto"),
    ("tamanho", "string", None, "Tamanho com unidade", "produto"),
    ("preco", "number", "(18,2)", "Preço de lista", "produto"),
    ("indicador", "text", None, "Indicador de retorno", "produto"),
    ("marca_produto", "string", None, "Marca", "produto"),
    ("status_exib_site", "LOV", None, "Exibe no site", "produto"),
    ("tamanho_erp", "number", None, "Tamanho no ERP", "produto"),
    ("arquivo_host", "string", None, "Servidor", "documento"),
    ("arquivo_idioma", "string", None, "Idioma", "documento;imagem"),
]
# Fixed values: (destination, catalogue id, output id, active).
OUTPUT_ROWS = [
    ("site", "tipo_produto", None, "1"),
    ("SITE", "Tamanho", "tamanho_produto", "true"),
    ("site", "preco", None, "1"),
    ("site", "indicador", "indicador_retorno", "1"),
    ("site", "marca_produto", None, "0"),
    ("site", "status_exib_site", None, "1"),
    ("site", "tamanho_erp", None, "1"),
    ("loja", "arquivo_host", None, "1"),
]
DESTINATION = "site"
INPUT_KEYS = "sistema_origem string, tabela_origem string, id_atributo_entrada string, id_atributo_catalogo string, ativo string"


def input_filter(spark: SparkSession) -> DataFrame:
    return small_rows(spark, INPUT_ROWS, INPUT_KEYS).withColumn("data_criacao", load_time())


def catalogue(spark: SparkSession) -> DataFrame:
    return small_rows(spark, CATALOGUE_ROWS, ATTRIBUTE_CATALOGUE)


def output_filter(spark: SparkSession) -> DataFrame:
    return small_rows(spark, OUTPUT_ROWS, OUTPUT_FILTER)


def part_input_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An input filter that grows with ``part``: one entry per part."""
    return table(spark, sf_dir, "part").select(
        F.lit("erp").alias("sistema_origem"),
        F.lit("part").alias("tabela_origem"),
        F.concat(F.lit(" Attr_"), text("p_partkey")).alias("id_atributo_entrada"),
        F.concat_ws("-", "p_brand", "p_type").alias("id_atributo_catalogo"),
        F.when(F.col("p_size") > 10, "1").otherwise("0").alias("ativo"),
        load_time().alias("data_criacao"),
    )


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue that grows with ``part``: one entry per brand and type."""
    kind = F.col("p_type")
    tables = (
        F.when(kind == "ECONOMY", "documento")
        .when(kind == "LARGE", "documento;imagem")
        .when(kind == "MEDIUM", "imagem")
        .when(kind != "PROMO", "produto")
    )
    types = (
        F.when(F.col("p_brand").endswith("1"), "LOV")
        .when(F.col("p_brand").endswith("2"), "number")
        .when(F.col("p_brand").endswith("3"), "text")
        .otherwise("string")
    )
    return (
        table(spark, sf_dir, "part")
        .select(
            F.concat_ws("-", "p_brand", "p_type").alias("id_atributo_catalogo"),
            types.alias("tipo_dado_atributo"),
            tables.alias("nome_tabela"),
        )
        .distinct()
    )


# --- hierarchies ------------------------------------------------------------------------------


def part_path() -> Column:
    """One to six nodes, by size."""
    nodes = F.array(
        F.lit("CAT"),
        F.col("p_brand"),
        F.concat_ws("-", "p_brand", "p_type"),
        F.concat(F.lit("S"), text("p_size")),
        F.lit("L4"),
        F.lit("L5"),
    )
    return F.slice(nodes, 1, F.col("p_size") % 6 + 1)


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        text("p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        part_brand().alias("brand"),
        "p_brand",
        "p_type",
        "p_size",
        part_path().alias("caminho"),
    )


def primary_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _paths(spark, sf_dir)
        .where(F.col("p_size") != 13)
        .select("sku", "name", "brand", F.struct(F.col("caminho").alias("primary")).alias("hierarchies"))
    )


def _secondary(df: DataFrame, kind: str, paths: Column) -> DataFrame:
    secondaries = F.struct(paths.alias(kind)).alias("secondaries")
    return df.select("sku", "name", "brand", F.struct(secondaries).alias("hierarchies"))


def marketing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _paths(spark, sf_dir).where(F.col("p_type").isin("PROMO", "LARGE", "SMALL"))
    path = F.slice(F.array(F.lit("MKT"), F.col("p_type"), F.col("p_brand")), 1, F.col("p_size") % 3 + 1)
    return _secondary(df.withColumn("brand", F.col("p_brand")), "marketing", F.array(path))


def website_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _paths(spark, sf_dir).where(F.col("p_type").isin("PROMO", "STANDARD"))
    path = F.slice(F.array(F.lit("WEB"), F.col("p_brand"), F.col("p_type")), 1, F.col("p_size") % 3 + 1)
    return _secondary(df, "website", F.array(path))


def site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site paths in their two shapes: a list of JSON paths, or the nodes of one path."""
    nested = F.array(
        F.to_json(F.array(F.lit("SITE-Site"), F.lit("X"))),
        F.to_json(F.array(F.lit("CAT"))),
        F.to_json("caminho"),
    )
    several = F.col("p_type").isin("PROMO", "LARGE", "MEDIUM")
    shape = F.array(F.when(several, nested).otherwise(F.col("caminho")))
    return _secondary(_paths(spark, sf_dir), "site", shape)


def hierarchy_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One node per distinct path, named with accents, its path as ancestors."""
    last = F.element_at("caminho", -1)
    return (
        _paths(spark, sf_dir)
        .select(
            F.array_join("caminho", "/").alias("_id"),
            F.concat(F.lit("Água "), last).alias("name"),
            F.lit("Casa").alias("brand"),
            F.col("caminho").alias("ancestors"),
        )
        .distinct()
    )


# Attributes asked for at each level of a path, as (field, required).
LEVEL_RULES = [
    [("TIPO", True), ("ref_x", True)],
    [("tamanho", True), ("retorno", False)],
    [("preco", True), ("cor", True)],
    [("hierarquia_web", True)],
    [("peso", True)],
    [("largura", True)],
]


def rule_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct path nodes with the attributes that their level asks for."""
    rules = F.array(
        *[
            F.array(
                *[F.struct(F.lit(f).alias("field"), F.lit(r).alias("required")) for f, r in level]
            )
            for level in LEVEL_RULES
        ]
    )
    return (
        _paths(spark, sf_dir)
        .select(F.posexplode("caminho").alias("nivel", "_id"))
        .distinct()
        .select("_id", F.get(rules, F.col("nivel")).alias("attributes"))
    )


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part linked to the node of its path."""
    return _paths(spark, sf_dir).select("sku", F.array_join("caminho", "/").alias("hierarquia"))


def named_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with names that need cleaning in a url, and skus with dots."""
    name = F.when(F.col("p_type") == "PROMO", F.concat(F.lit(' Açaí "'), "p_name", F.lit('" 1/2.5 ')))
    return table(spark, sf_dir, "part").select(
        text("p_partkey").alias("sku"),
        name.otherwise(F.col("p_name")).alias("nome_produto"),
        F.lower("p_brand").alias("marca"),
    )


def url_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Former urls of the small parts."""
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_type") == "SMALL")
        .select(
            text("p_partkey").alias("sku"),
            F.concat(F.lit("Antigo-"), text("p_partkey")).alias("url"),
            F.col("p_name").alias("palavra_chave"),
            F.col("p_brand").alias("produto_relacionado"),
            F.lit(None).cast("string").alias("assinatura_arquiteto"),
        )
    )


def shop_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop entries of every part by parent reference; promoted parts have two urls."""
    parts = table(spark, sf_dir, "part")
    key = text("p_partkey")

    def entries(rows: DataFrame, version: str) -> DataFrame:
        url = F.concat(F.lit(f"https://loja.example/{version}/"), key)
        return rows.select(
            F.concat(F.lit(" "), key, F.lit(PARENT_REFERENCE_SUFFIX)).alias("ProductRefId"),
            F.when(F.col("p_size") != 7, url).alias("DetailUrl"),
        )

    promoted = parts.where(F.col("p_type") == "PROMO")
    return entries(parts, "v1").unionByName(entries(promoted, "v2"))


# --- assets, references, ERP ------------------------------------------------------------------


def _page_head() -> dict[str, Column]:
    url = F.col("url")
    return {
        "sku": F.regexp_extract(url, "/([0-9]+)", 1),
        "lang": F.split_part(url, F.lit("/"), F.lit(4)),
        "host": F.split_part(url, F.lit("/"), F.lit(3)),
        "endereco": F.when(url.like("%.html"), F.lit(" ")).when(~url.like("%#top"), url),
    }


def _page_assets(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """One product document per page, holding one asset of the page."""

    def values(column: str) -> Column:
        return F.array(F.struct(F.col(column).alias("value"), F.lit(None).cast("string").alias("uom")))

    pages = table(spark, sf_dir, "pages").select("page_id", "url").withColumns(_page_head())
    attributes = F.array(
        _attribute("asset.host", F.lit("Host"), values("host")),
        _attribute("ASSET.LANG", F.when(F.col("lang") != "fr", F.lit("Idioma")), values("lang")),
    )
    type_id = (
        F.when(F.col("url").like("https%"), "DOC-manual").when(F.col("url").like("%?%"), "DOC-ficha")
    ).otherwise("DOC-cad")
    fields = {
        "id": F.concat(F.lit(" D"), text("page_id")),
        "name": F.when(F.col("lang") == "es", F.lit("")).otherwise(F.concat_ws("-", F.lit("Arquivo"), "host")),
        "assetType": F.lit(kind),
        "url": F.col("endereco"),
        "version": F.concat(F.lit("v"), F.col("lang")),
        "type": F.struct(type_id.alias("id"), F.concat_ws(" ", F.lit("Tipo"), type_id).alias("name")),
        "attributes": attributes,
    }
    if kind == "images":
        fields["resize"] = F.array(*[F.concat(F.lit("["), "url", F.lit(f"/{s}]")) for s in range(1, 6)])
    asset = F.struct(*[column.alias(name) for name, column in fields.items()])
    return pages.select(
        "sku",
        F.lit("Produto").alias("name"),
        F.when(F.col("lang") != "de", F.upper("lang")).alias("brand"),
        F.col("host").alias("subBrand"),
        F.struct(F.array(asset).alias(kind)).alias("assets"),
    )


def document_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_assets(spark, sf_dir, "documents")


def image_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_assets(spark, sf_dir, "images")


def page_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products behind the pages, with one product page each."""
    pages = table(spark, sf_dir, "pages").select("url").withColumns(_page_head())
    return pages.groupBy("sku").agg(F.max("url").alias("pagina"))


def crawl_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl of all page urls: some missing, some unreachable, some empty shop pages."""
    url = F.col("url")
    status = F.when(url.like("%#top"), -1).when(url.like("%ref=x"), 503).when(url.like("%.html"), 404)
    body = F.when(url.like("%utm_source%"), F.concat("html", F.lit(NOT_FOUND_PHRASE)))
    return table(spark, sf_dir, "pages").select(
        "url", status.otherwise(200).alias("status"), body.otherwise(F.col("html")).alias("body")
    )


def reference_products(spark: SparkSession, sf_dir: str, flag: str, path: str) -> DataFrame:
    """Order lines with one return flag as reference lists of the order."""
    keys = F.array(
        F.struct(F.lit("COD_MATERIAL").alias("id"), text("l_partkey").alias("value")),
        F.struct(F.lit("EAN").alias("id"), text("l_suppkey").alias("value")),
    )
    items = F.array(F.struct(keys.alias("keys"))).alias(path)
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == flag)
        .select(text("l_orderkey").alias("sku"), F.struct(items).alias("references"))
    )


def erp_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sector of each part type.
    sectors = {"ECONOMY": "LS", "LARGE": "HY", "MEDIUM": "MS", "PROMO": "LF", "SMALL": "01"}
    sector = F.lit("ZZ")
    for kind, code in sectors.items():
        sector = F.when(F.col("p_type") == kind, F.lit(code)).otherwise(sector)
    return table(spark, sf_dir, "part").select(
        F.concat(text("p_partkey"), F.lit("   ")).alias("matnr"),
        F.concat(F.lit("789"), text("p_partkey")).alias("ean11"),
        sector.alias("spart"),
        F.lit("UN ").alias("meins"),
        F.concat_ws("-", "p_brand", "p_type").alias("prdha"),
        F.concat(text("p_size"), F.lit("-x")).alias("groes"),
    )


def erp_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification object of every part, and a second one of another class for some."""
    part = table(spark, sf_dir, "part")
    key = text("p_partkey")
    main = part.select(
        F.concat(F.lit(" "), key).alias("objek"), F.lit("001 ").alias("klart"), F.concat(F.lit("C"), key).alias("cuobj")
    )
    other = part.where(F.col("p_type") == "PROMO").select(
        key.alias("objek"), F.lit("023").alias("klart"), F.concat(F.lit("C"), key).alias("cuobj")
    )
    return main.unionByName(other)


def erp_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as characteristic values of their part."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("C"), text("l_partkey")).alias("objek"),
        F.concat(text("l_linenumber"), F.lit(" ")).alias("atinn"),
        F.lit("001").alias("klart"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("atwrt"),
        F.when(F.col("l_linestatus") != "O", F.date_format("l_shipdate", "yyyyMMdd")).alias("date_from"),
        money("l_quantity").alias("atflv"),
    )


def erp_characteristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = text("l_linenumber")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_linenumber")
        .distinct()
        .select(number.alias("atinn"), F.concat(F.lit("CHAR_"), number).alias("atnam"))
    )


def erp_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_linenumber", "l_returnflag")
        .distinct()
        .select(
            text("l_linenumber").alias("atinn"),
            F.col("l_returnflag").alias("atwrt"),
            F.concat(F.lit("Z"), "l_returnflag").alias("atzhl"),
        )
    )


def erp_code_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portuguese text for flag A, English for R, none for N."""
    return (
        erp_codes(spark, sf_dir)
        .where(F.col("atwrt") != "N")
        .select(
            "atinn",
            "atzhl",
            F.when(F.col("atwrt") == "A", "PT").otherwise("EN").alias("spras"),
            F.concat(F.lit(" Descrição "), "atwrt").alias("atwtb"),
        )
    )


# --- two sources, target and stage ------------------------------------------------------------


def customer_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("sku"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("segmento"),
        text("c_nationkey").alias("nacao"),
        money("c_acctbal").cast("string").alias("saldo"),
    )


def customer_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: customers in credit, some values restyled, missing or different."""
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    name = F.when(segment == "BUILDING", F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
    kind = F.when(segment == "MACHINERY", "OTHER").when(segment != "FURNITURE", segment)
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") >= 0)
        .select(
            text("c_custkey").alias("sku"),
            name.otherwise(F.col("c_name")).alias("nome"),
            kind.alias("segmento"),
            F.when(nation == 13, nation + 1).otherwise(nation).cast("string").alias("nacao"),
            money("c_acctbal").cast("string").alias("saldo"),
        )
    )


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("sku"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("prioridade"),
        money("o_totalprice").cast("string").alias("valor"),
    )


def order_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_rows(spark, sf_dir).where(F.col("prioridade") != "1-URGENT")


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders: pending ones are still missing, low priorities are outdated."""
    rows = _order_rows(spark, sf_dir).where(F.col("status") != "P")
    old = F.when(F.col("prioridade") == "5-LOW", "OLD").otherwise(F.col("prioridade"))
    return rows.withColumns(
        {
            "prioridade": old,
            "created_at": F.lit("2020-01-01 00:00:00").cast("timestamp"),
            "updated_at": F.lit("2020-01-02 00:00:00").cast("timestamp"),
        }
    )


def _line_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("sku"),
        text("l_partkey").alias("id_arquivo"),
        text("l_suppkey").alias("id"),
        F.col("l_returnflag").alias("tipo_imagem"),
        text("l_linenumber").alias("nome_arquivo"),
        F.col("l_linestatus").alias("estado"),
        F.col("l_shipdate").alias("embarque"),
    )


IMAGE_KEYS = ["sku", "id_arquivo", "tipo_imagem", "nome_arquivo", "id"]


def image_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _line_images(spark, sf_dir).where(F.col("embarque") < "2000-01-01")
    return rows.withColumn("estado", F.lit("OLD")).drop("embarque")


def image_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_images(spark, sf_dir).where(F.col("embarque") >= "1997-01-01").drop("embarque")
