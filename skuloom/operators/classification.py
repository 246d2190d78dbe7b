"""Material classification from ERP tables and the commercial view on top of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import is_blank
from skuloom.operators.joins import lookup_join
from skuloom.operators.pivots import names_found, pivot_max


def trimmed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, as text without padding, so joins are plain equi-joins."""
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in columns])


def first_filled(*columns: Column, blank_as_null: bool = False) -> Column:
    """First non-null value; blank text counts as filled unless ``blank_as_null``."""
    if blank_as_null:
        columns = tuple(F.when(~is_blank(c), c) for c in columns)
    return F.coalesce(*columns)


def characteristic_values(
    ausp: DataFrame, cabn: DataFrame, blank_as_null: bool = False
) -> DataFrame:
    """(object, characteristic, class type, text value, attribute name, value) of ERP objects."""
    values = trimmed(ausp, "objek", "atinn", "klart", "atwrt", "date_from", "atflv")
    names = trimmed(cabn, "atinn", "atnam")
    value = first_filled(
        F.col("atwrt"), F.col("date_from"), F.col("atflv"), blank_as_null=blank_as_null
    )
    return lookup_join(values, names, ["atinn"], "inner").select(
        "objek", "atinn", "klart", "atwrt", F.lower("atnam").alias("atributo"), value.alias("valor")
    )


def describe_values(
    values: DataFrame, cawn: DataFrame, cawnt: DataFrame, language: str = K.DESCRIPTION_LANGUAGE
) -> DataFrame:
    """Add the description of coded values in one language; without one, the value itself."""
    texts = trimmed(cawnt.where(F.col("spras") == language), "atinn", "atzhl", "atwtb")
    codes = trimmed(cawn, "atinn", "atwrt", "atzhl").join(texts, ["atinn", "atzhl"], "left")
    described = lookup_join(values, codes.drop("atzhl"), ["atinn", "atwrt"], "left")
    return described.select(
        *values.columns, F.coalesce("atwtb", "valor").alias("caracteristica_interna")
    )


def _materials(mara: DataFrame, inob: DataFrame, class_type: str) -> DataFrame:
    materials = trimmed(mara, "matnr", "ean11", "spart", "meins", "prdha", "groes")
    objects = trimmed(inob, "objek", "klart", "cuobj").where(F.col("klart") == class_type)
    return materials.join(objects, materials["matnr"] == objects["objek"]).select(
        F.col("matnr").alias("sku"),
        F.col("ean11").alias("codigo_barras"),
        F.col("spart").alias("setor_atividade"),
        F.col("meins").alias("unidade_medida_basica"),
        "prdha",
        F.split_part("groes", F.lit("-"), F.lit(1)).alias("formato"),
        "cuobj",
    )


MATERIAL_KEYS = (
    "sku",
    "setor_atividade",
    "tipo_classe",
    "codigo_barras",
    "formato",
    "unidade_medida_basica",
    "prdha",
)


def classified_values(
    mara: DataFrame,
    inob: DataFrame,
    ausp: DataFrame,
    cabn: DataFrame,
    cawn: DataFrame,
    cawnt: DataFrame,
    class_type: str = K.MATERIAL_CLASS_TYPE,
    language: str = K.DESCRIPTION_LANGUAGE,
) -> DataFrame:
    """Long form: one row per material and characteristic value, with its description."""
    values = describe_values(characteristic_values(ausp, cabn), cawn, cawnt, language)
    materials = _materials(mara, inob, class_type)
    return values.join(materials, values["objek"] == materials["cuobj"]).select(
        "sku",
        "codigo_barras",
        "setor_atividade",
        F.col("atinn").alias("caracteristica"),
        F.col("klart").alias("tipo_classe"),
        "unidade_medida_basica",
        "prdha",
        "atributo",
        "formato",
        "valor",
        "caracteristica_interna",
    )


def classification(
    mara: DataFrame,
    inob: DataFrame,
    ausp: DataFrame,
    cabn: DataFrame,
    attributes: list[str] | None = None,
    class_type: str = K.MATERIAL_CLASS_TYPE,
    blank_as_null: bool = False,
) -> DataFrame:
    """One row per material and class type, one column per characteristic (largest value).

    The value table is by far the largest, so it is reduced to one row per object and
    characteristic before it meets the materials. Descriptions do not take part: they cannot
    change a maximum of values. Without ``attributes`` every characteristic of ``cabn`` gets its
    column, so one without any value gives a column of nulls.
    """
    if attributes is None:
        attributes = names_found(cabn.select(F.lower(F.trim("atnam")).alias("atnam")), "atnam")
    values = characteristic_values(ausp, cabn, blank_as_null)
    classed = values.withColumnRenamed("klart", "tipo_classe")
    objects = pivot_max(classed, ["objek", "tipo_classe"], "atributo", attributes, ["valor"])
    materials = _materials(mara, inob, class_type)
    joined = objects.join(materials, objects["objek"] == materials["cuobj"])
    return joined.groupBy(*MATERIAL_KEYS).agg(*[F.max(F.col(f"`{a}`")).alias(a) for a in attributes])


@dataclass(frozen=True)
class CommercialRules:
    """Where the columns of the commercial view come from, first filled source first."""

    line: tuple[str, ...]
    pattern: tuple[str, ...]
    environment: tuple[str, ...]
    converter: str
    product_columns: tuple[str, ...] = ()
    sectors: tuple[str, ...] = K.COMMERCIAL_SECTORS


def commercial_view(products: DataFrame, materials: DataFrame, rules: CommercialRules) -> DataFrame:
    """Classified materials of the commercial sectors with product data where there is any."""
    m = materials.where(F.col("setor_atividade").isin(*rules.sectors)).select(
        F.col("sku").alias("m_sku"),
        F.col("setor_atividade").alias("m_setor"),
        "codigo_barras",
        F.coalesce(*rules.line).alias("linha_2"),
        F.coalesce(*rules.pattern).alias("m_padrao"),
        F.coalesce(*rules.environment).alias("m_ambiente"),
        F.col(rules.converter).alias("conversor"),
        "unidade_medida_basica",
        F.col("prdha").alias("codigo_hierarquia"),
    )
    p = products.select(
        F.col("sku").alias("p_sku"),
        F.col("marca").alias("p_marca"),
        F.coalesce("status_venda", "status_venda_sap").alias("status_venda"),
        F.col("padrao").alias("p_padrao"),
        F.col("ambiente").alias("p_ambiente"),
        *rules.product_columns,
    )
    return p.join(m, p["p_sku"] == m["m_sku"], "right").select(
        F.coalesce("p_sku", "m_sku").alias("sku"),
        "codigo_barras",
        F.coalesce("p_marca", "m_setor").alias("marca"),
        "status_venda",
        F.left("codigo_hierarquia", F.lit(K.SIZE_CODE_LENGTH)).alias("codigo_tamanho"),
        F.left("codigo_hierarquia", F.lit(K.SEGMENT_CODE_LENGTH)).alias("segmento"),
        "linha_2",
        F.coalesce("p_padrao", "m_padrao").alias("padrao"),
        F.coalesce("p_ambiente", "m_ambiente").alias("ambiente"),
        "conversor",
        "unidade_medida_basica",
        "codigo_hierarquia",
        *rules.product_columns,
    )
