"""Document and image assets of products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import strip_brackets
from skuloom.operators.control import keep_active
from skuloom.operators.pivots import names_found, pivot_max


def _after_dash(column: Column) -> Column:
    return F.get(F.split(column, "-"), F.lit(1))


def _attribute_values(assets: DataFrame, keys: list[str], input_filter: DataFrame) -> DataFrame:
    """Active attributes of assets, one row per value, with the asset ``keys`` beside them."""
    attributes = assets.select(*keys, F.inline("attributes"))
    active = keep_active(attributes, "id", input_filter)
    return active.select(
        *keys, F.lower("id").alias("atributo"), F.col("name").alias("nome_atributo"), F.inline("values")
    )


def document_assets(
    products: DataFrame, input_filter: DataFrame, attributes: list[str] | None = None
) -> DataFrame:
    """One row per document version, one column per asset attribute (its largest value).

    Without ``attributes`` every active attribute that the assets carry gets its column.
    """
    assets = products.select("sku", F.col("brand").alias("marca"), F.inline("assets.documents"))
    named = assets.select(
        "sku",
        "marca",
        F.lit("documento").alias("tipo_arquivo"),
        F.col("name").alias("nome_arquivo_documento"),
        F.col("type.name").alias("descricao"),
        "url",
        F.col("version").alias("versao"),
        "attributes",
    )
    keys = [c for c in named.columns if c != "attributes"]
    values = _attribute_values(named, keys, input_filter)
    if attributes is None:
        attributes = names_found(values, "atributo")
    return pivot_max(values, keys, "atributo", attributes, ["value"])


def image_assets(
    products: DataFrame, input_filter: DataFrame, attributes: list[str] | None = None
) -> DataFrame:
    """One row per image, attribute name and unit, one column per asset attribute.

    Without ``attributes`` every active attribute that the assets carry gets its column.
    """
    assets = products.select(
        "sku",
        F.col("brand").alias("marca"),
        F.col("subBrand").alias("sub_marca"),
        F.col("name").alias("nome"),
        F.inline("assets.images"),
    )
    named = assets.select(
        "sku",
        "marca",
        "sub_marca",
        "nome",
        _after_dash(F.col("type.id")).alias("tipo_imagem"),
        F.col("assetType").alias("tipo_arquivo"),
        F.col("id").alias("id_arquivo"),
        F.col("name").alias("nome_arquivo_imagem"),
        "resize",
        "attributes",
    )
    keys = [c for c in named.columns if c != "attributes"]
    values = _attribute_values(named, keys, input_filter).withColumnRenamed("uom", "unidade_medida")
    if attributes is None:
        attributes = names_found(values, "atributo")
    return pivot_max(
        values, [*keys, "nome_atributo", "unidade_medida"], "atributo", attributes, ["value"]
    )


def documents_by_type(
    products: DataFrame, documents: DataFrame, types: list[str] | None = None
) -> DataFrame:
    """Products with one column per document type holding its largest url.

    Without ``types`` every type of the documents that count gets its column.
    Only documents that carry at least one attribute value count; testing the nested lists is
    enough, because copies of a url do not change its maximum. Rows that differ only in the brand
    of their documents are merged before the join, while they are narrow.
    """
    assets = documents.select("sku", F.inline("assets.documents"), F.col("brand").alias("marca"))
    filled = assets.where(F.exists("attributes", lambda a: F.size(a["values"]) > 0))
    named = filled.select(
        F.col("sku").alias("doc_sku"),
        "marca",
        F.lit("documento").alias("tipo_arquivo"),
        F.lower("type.id").alias("id_ref"),
        "url",
    )
    keys = ["doc_sku", "marca", "tipo_arquivo"]
    if types is None:
        types = names_found(named, "id_ref")
    wide = pivot_max(named, keys, "id_ref", types, ["url"]).drop("marca").distinct()
    return products.join(wide, products["sku"] == wide["doc_sku"], "left").drop("doc_sku")


def image_sizes(images: DataFrame, resize: str = "resize") -> DataFrame:
    """Named size columns from the resize list, given as an array or as its text."""
    if images.schema[resize].dataType.typeName() == "array":
        parts = F.col(resize)
    else:
        parts = F.split(F.col(resize), ",")
    sizes = [
        F.trim(strip_brackets(F.get(parts, F.lit(i)))).alias(f"tamanho_{size}")
        for i, size in enumerate(K.IMAGE_SIZES)
    ]
    return images.select(*[c for c in images.columns if c != resize], *sizes)
