"""Texts, separators and lookups that decide results and must not drift.

They are defaults; every operator that uses one takes it as a parameter.
"""

# Separators of joined multi-values.
MULTI_VALUE_SEPARATOR = " ; "
REFERENCE_SEPARATOR = ";"

# Attribute and key names with a special role.
BRAND_ATTRIBUTE = "brand"
BRAND_ROW_ATTRIBUTE = "marca"
SITE_FLAG_ATTRIBUTE = "status_exib_site"
SITE_FLAG_VALUE = "sim"
REFERENCE_KEY_ID = "COD_MATERIAL"
PARENT_REFERENCE_SUFFIX = "_PAI"
SITE_ROOT_NODE = "SITE-Site"

# Output flags.
YES = "Sim"
NO = "Não"
TRUE_WORDS = ("1", "true", "sim")

# Completeness: attributes that are never asked for.
EXCLUDED_ATTRIBUTE_PATTERN = "%ref%"
EXCLUDED_ATTRIBUTE = "hierarquia_web"
COMPLETENESS_LEVELS = 5

# ERP classification.
MATERIAL_CLASS_TYPE = "001"
DESCRIPTION_LANGUAGE = "PT"
COMMERCIAL_SECTORS = ("LS", "HY", "MS", "LF", "01")
SIZE_CODE_LENGTH = 3
SEGMENT_CODE_LENGTH = 8

# Accent folding for URLs, character by character.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
UNACCENTED = "aaaaaeeeeiiiiooooouuuuc"

# A shop page that answers 200 but shows this text does not exist.
NOT_FOUND_PHRASE = "Desculpe, a página não foi encontrada"

# Image sizes in the order of the resize list.
IMAGE_SIZES = ("g", "m", "p", "sqr_1_k", "gg", "ggg")

# Catalogue data types that are written differently in Spark.
CATALOGUE_TYPES = {
    "lov": "string",
    "text": "string",
    "number": "numeric",
    "isodate": "timestamp",
}

# Attribute classes: tables named in the catalogue.
DOCUMENT_TABLES = ("documento", "documento;imagem")
IMAGE_TABLES = ("imagem", "documento;imagem")

# Audit columns that a publish target expects to be present and blank.
BLANK_AUDIT_COLUMNS = ("created_by_id", "updated_by_id", "sitemap_exclude")
STAGE_AUDIT_COLUMNS = ("created_at", "updated_at", *BLANK_AUDIT_COLUMNS)
