"""Relational and scalar building blocks over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions import arrays, text
from skuloom.operators import control, eav, ids, joins, publish
from skuloom.plans import inputs as I
from skuloom.plans import oracle as O
from skuloom.plans.registry import query


@query(
    "p03_rename_by_map",
    "SELECT c_custkey AS sku, c_name AS nome_produto, c_nationkey, c_mktsegment AS segmento FROM customer",
)
def rename(spark: SparkSession, sf: str) -> DataFrame:
    names = {"C_CUSTKEY": "SKU", "c_name": "nome_produto", "c_mktsegment": "Segmento", "x": "y"}
    customers = I.table(spark, sf, "customer").drop("c_acctbal")
    return publish.rename_by_map(customers, names)


@query(
    "p06_active_filter",
    f"WITH {O.RAW} SELECT sku, id, value FROM raw WHERE brand IS NOT NULL AND lower(id) IN {O.ACTIVE}",
)
def active_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = eav.attribute_rows(I.products(spark, sf))
    kept = control.keep_active(rows, "id", I.input_filter(spark))
    return eav.value_rows(kept).select("sku", "id", "value")


_URGENT = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"


@query(
    "p07_semi_filter",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_URGENT})",
)
def semi_filter(spark: SparkSession, sf: str) -> DataFrame:
    urgent = I.table(spark, sf, "orders").where(_URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return I.table(spark, sf, "customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_semi")


@query(
    "p15_blank_fill",
    f"""WITH {O.CUSTOMERS} SELECT coalesce(trim(sku), '') AS sku, coalesce(trim(nome), '') AS nome,
    coalesce(trim(segmento), '') AS segmento, coalesce(trim(nacao), '') AS nacao,
    coalesce(trim(saldo), '') AS saldo FROM dir""",
)
def blank_fill(spark: SparkSession, sf: str) -> DataFrame:
    return text.blank_fill(I.customer_right(spark, sf))


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _line_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as documents: three fields each, none for flag N, no list at all for status O."""

    def field(name: str, value: F.Column) -> F.Column:
        return F.struct(F.lit(name).alias("campo"), value.alias("valor"))

    quantity = I.money("l_quantity").cast("string")
    fields = F.array(
        field("indicador", F.col("l_returnflag")),
        field("estado", F.col("l_linestatus")),
        field("quantidade", quantity),
    )
    filled = F.filter(fields, lambda _: F.col("l_returnflag") != "N")
    listed = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), None).otherwise(filled)
    return I.table(spark, sf, "lineitem").select(*_LINE_KEYS, listed.alias("campos"))


_FIELDS = """campos AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c.pos, c.campo, c.valor
  FROM lineitem, LATERAL (SELECT 0 AS pos, 'indicador' AS campo, l_returnflag AS valor
    UNION ALL SELECT 1, 'estado', l_linestatus
    UNION ALL SELECT 2, 'quantidade', CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)) c
  WHERE l_returnflag <> 'N')"""
_KEYS_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("g01_inline", f"WITH {_FIELDS} SELECT {_KEYS_SQL}, campo, valor FROM campos")
def inline(spark: SparkSession, sf: str) -> DataFrame:
    return _line_arrays(spark, sf).select(*_LINE_KEYS, F.inline("campos"))


@query("g02_explode", f"WITH {_FIELDS} SELECT {_KEYS_SQL}, valor FROM campos")
def explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = _line_arrays(spark, sf).select(*_LINE_KEYS, F.explode("campos").alias("campo"))
    return rows.select(*_LINE_KEYS, F.col("campo.valor").alias("valor"))


@query(
    "g03_posexplode_outer",
    f"""WITH {_FIELDS} SELECT {_KEYS_SQL}, CAST(pos AS VARCHAR) AS pos, campo FROM campos
    UNION ALL SELECT {_KEYS_SQL}, '-', NULL FROM lineitem WHERE l_returnflag = 'N'""",
)
def posexplode_outer(spark: SparkSession, sf: str) -> DataFrame:
    rows = _line_arrays(spark, sf).select(*_LINE_KEYS, F.posexplode_outer("campos").alias("pos", "item"))
    return rows.select(
        *_LINE_KEYS,
        F.coalesce(F.col("pos").cast("string"), F.lit("-")).alias("pos"),
        F.col("item.campo").alias("campo"),
    )


@query(
    "f01_string_scalars",
    """SELECT p_partkey, lower(p_type) AS minusculo, upper(p_name) AS maiusculo,
    trim('  ' || p_type || ' ') AS aparado,
    upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
      upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS capitalizado,
    p_brand || '/' || CASE WHEN p_size <> 17 THEN p_type END AS concatenado,
    concat_ws('-', p_brand, CASE WHEN p_size <> 17 THEN p_type END) AS com_separador,
    replace(p_name, ' ', '-') AS trocado, replace(p_brand, '#', '') AS apagado,
    translate('ção ' || p_name, 'áàâãäéèêëíìîïóòôõöúùûüç', 'aaaaaeeeeiiiiooooouuuuc') AS sem_acento,
    regexp_replace(p_name, '[aeiou]', '*', 'g') AS mascarado,
    split_part(p_brand, '#', 2) AS segunda_parte,
    CASE WHEN p_size > 9 THEN split_part(p_name, ' ', 2) END AS pedaco,
    replace(url_encode(p_brand || '/ç ' || p_name), '%2F', '/') AS codificado, left(p_type, 3) AS prefixo, CAST(length(p_name) AS BIGINT) AS tamanho
    FROM part""",
)
def string_scalars(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("p_size") != 17, F.col("p_type"))
    dashed = F.when(F.col("p_size") > 9, F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    return I.table(spark, sf, "part").select(
        "p_partkey",
        F.lower("p_type").alias("minusculo"),
        F.upper("p_name").alias("maiusculo"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("aparado"),
        F.initcap("p_name").alias("capitalizado"),
        F.concat("p_brand", F.lit("/"), kind).alias("concatenado"),
        F.concat_ws("-", "p_brand", kind).alias("com_separador"),
        text.dashed(F.col("p_name")).alias("trocado"),
        text.without(F.col("p_brand"), "#").alias("apagado"),
        text.fold_accents(F.concat(F.lit("ção "), "p_name")).alias("sem_acento"),
        F.regexp_replace("p_name", "[aeiou]", "*").alias("mascarado"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("segunda_parte"),
        F.get(F.split(dashed, " "), F.lit(1)).alias("pedaco"),
        text.encode_url(F.concat("p_brand", F.lit("/ç "), "p_name")).alias("codificado"),
        F.left("p_type", F.lit(3)).alias("prefixo"),
        F.length("p_name").cast("bigint").alias("tamanho"),
    )


@query(
    "f07_conditional_scalars",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS sku,
    CASE WHEN p_size > 40 THEN 'G' WHEN p_size > 20 THEN 'M' ELSE 'P' END AS faixa,
    coalesce({O.BRAND}, p_type) AS nvl_, coalesce({O.BRAND}, 'sem') AS ifnull_,
    coalesce({O.BRAND}, CASE WHEN p_type = 'PROMO' THEN p_type END, p_name) AS coalesce_,
    coalesce(CAST(CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS VARCHAR) IN ('1'), false) AS indicador,
    CASE WHEN trim(CASE WHEN p_size = 19 THEN '  ' ELSE p_type END) = '' THEN 'vazio' ELSE 'cheio' END AS vazio
    FROM part""",
)
def conditional_scalars(spark: SparkSession, sf: str) -> DataFrame:
    size, brand = F.col("p_size"), I.part_brand()
    small = F.when(F.col("p_type") == "SMALL", 1).otherwise(0)
    spaced = F.when(size == 19, F.lit("  ")).otherwise(F.col("p_type"))
    return I.table(spark, sf, "part").select(
        I.text("p_partkey").alias("sku"),
        F.when(size > 40, "G").when(size > 20, "M").otherwise("P").alias("faixa"),
        F.nvl(brand, F.col("p_type")).alias("nvl_"),
        F.ifnull(brand, F.lit("sem")).alias("ifnull_"),
        F.coalesce(brand, F.when(F.col("p_type") == "PROMO", F.col("p_type")), "p_name").alias("coalesce_"),
        text.flag(small).alias("indicador"),
        F.when(text.is_blank(spaced), "vazio").otherwise("cheio").alias("vazio"),
    )


@query(
    "f09_safe_casts",
    """SELECT p_partkey, TRY_CAST(t AS DECIMAL(10,0)) IS NULL AS invalido,
    CAST(TRY_CAST(t AS DECIMAL(10,0)) AS VARCHAR) AS inteiro,
    CAST(TRY_CAST(t AS DECIMAL(18,2)) AS VARCHAR) AS decimal_,
    replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS com_virgula,
    CAST(p_size AS VARCHAR) AS texto
    FROM (SELECT *, CASE WHEN p_size = 23 THEN 'n/a' WHEN p_size = 24 THEN '12345678901'
      WHEN p_size = 25 THEN '' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS t FROM part)""",
)
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    raw = F.when(size == 23, "n/a").when(size == 24, "12345678901").when(size == 25, "")
    t = F.col("t")
    return (
        I.table(spark, sf, "part")
        .withColumn("t", raw.otherwise(I.money("p_retailprice").cast("string")))
        .select(
            "p_partkey",
            t.try_cast("decimal(10,0)").isNull().alias("invalido"),
            t.try_cast("decimal(10,0)").cast("string").alias("inteiro"),
            t.try_cast("decimal(18,2)").cast("string").alias("decimal_"),
            text.decimal_comma(I.money("p_retailprice")).alias("com_virgula"),
            I.text("p_size").alias("texto"),
        )
    )


@query(
    "f10_array_scalars",
    f"""WITH {O.PATHS} SELECT sku, path[1] AS n0, path[2] AS n1, path[6] AS n5, path[8] AS n7,
    path[len(path)] AS fundo, path[2] IS NOT NULL AS tem_nivel1 FROM paths WHERE p_size <> 13""",
)
def array_scalars(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("hierarchies.primary")
    return I.primary_paths(spark, sf).select(
        "sku",
        *[arrays.level(path, i).alias(f"n{i}") for i in (0, 1, 5, 7)],
        arrays.deepest(path).alias("fundo"),
        arrays.level(path, 1).isNotNull().alias("tem_nivel1"),
    )


@query(
    "j01_inner",
    """SELECT o_orderkey, c_name, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal > 0""",
)
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    customers = I.table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    orders = I.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey")
    )
    return joins.lookup_join(orders, customers, ["c_custkey"], "inner").drop("c_custkey")


@query(
    "j04_normalised_key",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def normalised_key(spark: SparkSession, sf: str) -> DataFrame:
    place = F.concat(F.lit(" nation_"), I.text("c_nationkey"), F.lit("  "))
    customers = I.table(spark, sf, "customer").select("c_custkey", place.alias("lugar"))
    nations = I.table(spark, sf, "nation").select("n_name")
    return joins.join_normalised(customers, nations, "lugar", "n_name").select("c_custkey", "n_name")


@query(
    "j07_link_star",
    """SELECT o_orderkey, o_orderstatus, coalesce(f.nomes, '') AS fornecedores, coalesce(p.nomes, '') AS pecas
    FROM orders
    LEFT JOIN (SELECT l_orderkey, string_agg(s_name, ';' ORDER BY s_name) AS nomes FROM (
      SELECT DISTINCT l_orderkey, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
      GROUP BY l_orderkey) f ON f.l_orderkey = o_orderkey
    LEFT JOIN (SELECT l_orderkey, string_agg(p_name, ';' ORDER BY p_name) AS nomes FROM (
      SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey)
      GROUP BY l_orderkey) p ON p.l_orderkey = o_orderkey""",
)
def link_star(spark: SparkSession, sf: str) -> DataFrame:
    lines = I.table(spark, sf, "lineitem")
    owners = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    suppliers = I.table(spark, sf, "supplier")
    parts = I.table(spark, sf, "part")
    fields = [
        joins.Link("fornecedores", lines, "l_orderkey", "l_suppkey", suppliers, "s_suppkey", "s_name"),
        joins.Link("pecas", lines, "l_orderkey", "l_partkey", parts, "p_partkey", "p_name"),
    ]
    return joins.link_star(owners, "o_orderkey", fields)


@query(
    "j09_anti",
    f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {_URGENT})",
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    urgent = I.table(spark, sf, "orders").where(_URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return I.table(spark, sf, "customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_anti")


@query(
    "j10_semi",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey IN (
    SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48)""",
)
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    returned = (
        I.table(spark, sf, "lineitem")
        .where("l_returnflag = 'R' AND l_quantity >= 48")
        .select(F.col("l_partkey").alias("p_partkey"))
        .distinct()
    )
    return I.table(spark, sf, "part").select("p_partkey", "p_name").join(returned, "p_partkey", "left_semi")


@query(
    "a01_group_max",
    f"WITH {O.RAW} SELECT sku, lower(id) AS atributo, max(value) AS valor FROM raw WHERE brand IS NOT NULL GROUP BY 1, 2",
)
def group_max(spark: SparkSession, sf: str) -> DataFrame:
    values = eav.value_rows(eav.attribute_rows(I.products(spark, sf)))
    return values.groupBy("sku", F.lower("id").alias("atributo")).agg(F.max("value").alias("valor"))


@query(
    "a02_concat_group",
    """SELECT l_partkey, string_agg(l_returnflag, ' ; ' ORDER BY l_returnflag) AS indicadores
    FROM (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem) GROUP BY l_partkey""",
)
def concat_group(spark: SparkSession, sf: str) -> DataFrame:
    lines = I.table(spark, sf, "lineitem")
    return eav.concat_group(
        lines, ["l_partkey"], "l_returnflag", K.MULTI_VALUE_SEPARATOR, "indicadores", unique=True
    )


@query("a03_group_count", "SELECT event_type, count(*) AS contagem FROM events GROUP BY event_type")
def group_count(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("contagem"))


@query("a04_distinct", "SELECT DISTINCT lang, source FROM documents")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "documents").select("lang", "source").distinct()


@query(
    "a05_pivot",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
    count(*) FILTER (WHERE l_linestatus = 'O') AS "O" FROM lineitem GROUP BY l_returnflag""",
)
def pivot(spark: SparkSession, sf: str) -> DataFrame:
    counts = I.table(spark, sf, "lineitem").groupBy("l_returnflag").pivot("l_linestatus")
    return counts.agg(F.count(F.lit(1))).na.fill(0)


@query("a06_unpivot", f"WITH {O.ERP_STRING} SELECT sku, atributo, valor FROM erp_string")
def unpivot(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.table(spark, sf, "part").withColumn("sku", I.text("p_partkey"))
    return parts.unpivot("sku", ["p_name", "p_brand", "p_type"], "atributo", "valor")


@query(
    "w01_surrogate_id",
    """SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id FROM customer""",
)
def surrogate_id(spark: SparkSession, sf: str) -> DataFrame:
    return ids.surrogate_id(I.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query(
    "w01_increment",
    """WITH velhos AS (
      SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id
      FROM customer WHERE c_custkey % 3 > 0),
    novos AS (
      SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey)
        + (SELECT max(id) FROM velhos) AS id
      FROM customer WHERE c_custkey % 3 = 0)
    SELECT * FROM velhos WHERE c_custkey % 7 > 0 UNION ALL SELECT * FROM novos WHERE c_custkey % 7 > 0
    UNION ALL SELECT c_custkey, 'NOVO', id FROM velhos WHERE c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, 'NOVO', id FROM novos WHERE c_custkey % 7 = 0""",
)
def surrogate_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the customers have ids; then all are numbered, some with other attributes."""
    customers = I.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    first = ids.surrogate_id(customers.where("c_custkey % 3 > 0"), ["c_mktsegment"])
    rows = ids.surrogate_increment(first, customers, ["c_custkey"], ["c_mktsegment"])
    return rows.withColumn("c_mktsegment", F.when(F.expr("c_custkey % 7 = 0"), "NOVO").otherwise(F.col("c_mktsegment")))


_HASH_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name,
    CAST('0x' || substr(md5(length(CAST(p_partkey AS VARCHAR)) || ':' || p_partkey), 1, 15) AS BIGINT) AS id FROM part"""


@query("w02_hash_id", _HASH_SQL)
def hash_id(spark: SparkSession, sf: str) -> DataFrame:
    parts = I.table(spark, sf, "part").select(I.text("p_partkey").alias("sku"), "p_name")
    return ids.hash_id(parts, ["sku"])


@query("w02_resolved_id", _HASH_SQL)
def resolved_id(spark: SparkSession, sf: str) -> DataFrame:
    """The same ids where none collide; ``tests`` force collisions with fewer bits."""
    parts = I.table(spark, sf, "part").select(I.text("p_partkey").alias("sku"), "p_name")
    return ids.resolved_id(parts, ["sku"])


@query("w02_id_uniqueness", "SELECT CAST(p_partkey AS VARCHAR) AS sku, 1 AS skus_por_id FROM part")
def id_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    """How many skus share the hash id of each sku."""
    parts = I.table(spark, sf, "part").select(I.text("p_partkey").alias("sku"))
    shared = ids.hash_id(parts, ["sku"]).groupBy("id").agg(F.collect_set("sku").alias("skus"))
    return shared.select(F.explode("skus").alias("sku"), F.size("skus").alias("skus_por_id"))


@query(
    "o02_array_sort",
    f"""SELECT {_KEYS_SQL}, array_to_string(list_sort([l_returnflag, l_linestatus,
    CAST(l_linenumber AS VARCHAR)]), ',') AS ordenado FROM lineitem""",
)
def array_sort(spark: SparkSession, sf: str) -> DataFrame:
    values = F.array("l_returnflag", "l_linestatus", I.text("l_linenumber"))
    return I.table(spark, sf, "lineitem").select(
        *_LINE_KEYS, F.array_join(F.array_sort(values), ",").alias("ordenado")
    )


@query(
    "u01_union_distinct",
    "SELECT c_nationkey AS nacao FROM customer UNION SELECT s_nationkey FROM supplier",
)
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _nations(spark, sf).distinct()


@query(
    "u02_union_all",
    "SELECT c_nationkey AS nacao FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    return _nations(spark, sf)


def _nations(spark: SparkSession, sf: str) -> DataFrame:
    customers = I.table(spark, sf, "customer").select(F.col("c_nationkey").alias("nacao"))
    return customers.unionByName(I.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nacao")))
