"""Site products: the published product table put together from its parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.operators.assets import documents_by_type
from skuloom.operators.eav import wide_product
from skuloom.operators.hierarchy import on_site
from skuloom.operators.publish import Spec, institutional_urls, typed_publish
from skuloom.operators.references import reference_lists
from skuloom.operators.sync import update_shop_urls


@dataclass(frozen=True)
class SiteInputs:
    """Tables that the site products are made of."""

    eav_tables: list[DataFrame]
    names: DataFrame
    documents: DataFrame
    related: DataFrame
    installation: DataFrame
    site_links: DataFrame
    hierarchy: DataFrame
    history: DataFrame
    shop: DataFrame


def site_products(
    tables: SiteInputs,
    spec: Spec,
    base_url: str,
    shop_column: str,
    document_types: list[str] | None = None,
) -> DataFrame:
    """Wide products shown on the site with documents, references and urls, typed by the spec.

    Every step after the pivot is a join on sku, so the steps share the partitioning of the pivot.
    Each joined side is distinct already, so the wide rows are never compared as a whole.
    """
    requested = [source for source, *_ in spec if source]
    wide = wide_product(tables.eav_tables, requested)
    shown = on_site(wide, tables.site_links, tables.hierarchy)
    documented = documents_by_type(shown, tables.documents, document_types)
    lists = reference_lists(tables.related, tables.installation)
    urls = institutional_urls(
        tables.names, tables.site_links, tables.hierarchy, tables.history, base_url
    )
    complete = documented.join(lists, "sku", "left").join(urls, "sku", "left")
    typed = typed_publish(complete, spec, distinct=False).withColumn(shop_column, F.lit(None).cast("string"))
    return update_shop_urls(typed, tables.shop, K.PARENT_REFERENCE_SUFFIX, shop_column)
