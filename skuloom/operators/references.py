"""Related and installation items of products as code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.operators.eav import concat_group


def reference_codes(products: DataFrame, path: str, output: str) -> DataFrame:
    """Item codes below one reference list, joined per sku."""
    items = products.select("sku", F.inline(path)).select("sku", F.inline("keys"))
    codes = items.where(F.col("id") == K.REFERENCE_KEY_ID)
    return concat_group(codes, ["sku"], "value", K.REFERENCE_SEPARATOR, output)


def reference_lists(related: DataFrame, installation: DataFrame) -> DataFrame:
    """Both code lists side by side; both sides are unique per sku, so no key can be hot."""
    left = reference_codes(related, "references.relatedItems", "relatedItems")
    right = reference_codes(installation, "references.installationItems", "installationItems")
    return left.join(right, "sku", "full_outer")
