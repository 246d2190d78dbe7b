"""Explicit schemas of the inputs; readers never infer."""

from __future__ import annotations

_VALUES = "array<struct<value:string,valueId:string,subValue:string,uom:string>>"
_KEYS = "array<struct<id:string,value:string>>"
_ATTRIBUTES = f"array<struct<id:string,name:string,values:{_VALUES}>>"
_ASSET = (
    "id:string,name:string,assetType:string,url:string,version:string,"
    "type:struct<id:string,name:string>,"
    "attributes:array<struct<id:string,name:string,values:array<struct<value:string,uom:string>>>>"
)
_HEAD = "sku string, name string, brand string, subBrand string, updateDate string"
_PATHS = "array<array<string>>"

PRODUCT_ATTRIBUTES = f"{_HEAD}, keys {_KEYS}, attributes {_ATTRIBUTES}"
PRODUCT_DOCUMENTS = f"{_HEAD}, keys {_KEYS}, assets struct<documents:array<struct<{_ASSET}>>>"
PRODUCT_IMAGES = (
    f"{_HEAD}, keys {_KEYS}, assets struct<images:array<struct<{_ASSET},resize:array<string>>>>"
)
PRODUCT_RELATED = f"{_HEAD}, references struct<relatedItems:array<struct<keys:{_KEYS}>>>"
PRODUCT_INSTALLATION = f"{_HEAD}, references struct<installationItems:array<struct<keys:{_KEYS}>>>"
HIERARCHY = (
    "_id string, name string, brand string, ancestorsId array<string>, ancestors array<string>, "
    "attributes array<struct<field:string,required:boolean>>"
)
PRODUCT_PRIMARY = f"{_HEAD}, keys {_KEYS}, hierarchies struct<primary:array<string>>"
PRODUCT_MARKETING = f"{_HEAD}, keys {_KEYS}, hierarchies struct<secondaries:struct<marketing:{_PATHS}>>"
PRODUCT_WEBSITE = f"{_HEAD}, keys {_KEYS}, hierarchies struct<secondaries:struct<website:{_PATHS}>>"
PRODUCT_SITE = f"{_HEAD}, keys {_KEYS}, hierarchies struct<secondaries:struct<site:{_PATHS}>>"


def asset_check_fields(kind: str) -> str:
    """The fields that the asset checks need, for reading a stored asset table narrowly."""
    attributes = "attributes:array<struct<id:string,name:string>>"
    return (
        f"sku string, brand string, "
        f"assets struct<{kind}:array<struct<id:string,name:string,url:string,{attributes}>>>"
    )


ATTRIBUTE_COLLECTION = (
    "id string, type string, brands array<string>, domains array<string>, status string, "
    "values array<string>"
)
PRODUCT_ATTRIBUTE_COLLECTION = (
    "_id string, type string, name string, uom string, format string, multiSelect boolean, "
    "maxSize string, min string, max string, mask string, brandMetadata string"
)
LOVS = "_id string, lovName string, valueHelp string"

INPUT_FILTER = (
    "sistema_origem string, tabela_origem string, id_atributo_entrada string, "
    "id_atributo_catalogo string, ativo string, data_criacao timestamp"
)
ATTRIBUTE_CATALOGUE = (
    "id_atributo_catalogo string, tipo_dado_atributo string, casa_decimal string, "
    "descricao string, nome_tabela string"
)
OUTPUT_FILTER = (
    "sistema_destino string, id_atributo_catalogo string, id_atributo_saida string, ativo string"
)
CONTROL_TABLES = {
    "filtro_entrada": INPUT_FILTER,
    "catalogo_atributo": ATTRIBUTE_CATALOGUE,
    "filtro_saida": OUTPUT_FILTER,
}

# Landed collections: name -> (schema, path that must be present).
COLLECTIONS = {
    "product_attributes": (PRODUCT_ATTRIBUTES, "attributes"),
    "product_documents": (PRODUCT_DOCUMENTS, "assets.documents"),
    "product_images": (PRODUCT_IMAGES, "assets.images"),
    "product_related": (PRODUCT_RELATED, "references.relatedItems"),
    "product_installation": (PRODUCT_INSTALLATION, "references.installationItems"),
    "hierarchy": (HIERARCHY, "_id"),
    "product_primary": (PRODUCT_PRIMARY, "hierarchies.primary"),
    "product_marketing": (PRODUCT_MARKETING, "hierarchies.secondaries.marketing"),
    "product_website": (PRODUCT_WEBSITE, "hierarchies.secondaries.website"),
    "product_site": (PRODUCT_SITE, "hierarchies.secondaries.site"),
    "attribute_collection": (ATTRIBUTE_COLLECTION, "id"),
    "product_attribute_collection": (PRODUCT_ATTRIBUTE_COLLECTION, "_id"),
    "lovs": (LOVS, "_id"),
}
