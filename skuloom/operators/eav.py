"""Entity-attribute-value store: build from documents, unpivot into it, pivot out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import is_blank, joined, with_unit
from skuloom.functions.types import columns_by_family, family_of, stored_type
from skuloom.operators.control import keep_active
from skuloom.operators.pivots import pivot_max
from skuloom.sources.snapshots import publish_slices
from skuloom.sources.tables import union_tables

MAX_UNIT_ATTRIBUTES = 10_000


def attribute_rows(products: DataFrame) -> DataFrame:
    """One row per attribute of every branded product; values stay nested."""
    return products.where(F.col("brand").isNotNull()).select(
        "sku", F.col("name").alias("nome_produto"), "brand", "updateDate", F.inline("attributes")
    )


def value_rows(attributes: DataFrame) -> DataFrame:
    """One row per attribute value."""
    return attributes.select(
        "sku", "nome_produto", "brand", "updateDate", "id", "name", F.inline("values")
    )


def concat_group(
    df: DataFrame, keys: list[str], value: str, separator: str, output: str, unique: bool = False
) -> DataFrame:
    """Values of each group joined into one text in sorted order, once each if ``unique``.

    Equal values are counted first, by key and value: copies collapse before the shuffle, and the
    distinct values of a hot key are counted in many tasks. Only distinct values are gathered.
    """
    counted = df.groupBy(*keys, F.col(value).alias("valor")).agg(F.count(F.lit(1)).cast("int").alias("vezes"))
    gathered = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("valor", "vezes"))).alias("valores")
    )
    if unique:
        texts = F.transform("valores", lambda v: v["valor"])
    else:
        texts = F.flatten(F.transform("valores", lambda v: F.array_repeat(v["valor"], v["vezes"])))
    return gathered.select(*keys, F.concat_ws(separator, texts).alias(output))


def eav_build(
    products: DataFrame,
    input_filter: DataFrame,
    origin: str,
    load_time: Column,
    separator: str = K.MULTI_VALUE_SEPARATOR,
) -> DataFrame:
    """Flatten products into (source, load time, sku, product name, attribute, value).

    Attributes are filtered before their values are expanded. Details are made distinct and
    counted by brand and text as flat rows, which drops copies before each shuffle and spreads a
    hot attribute over many tasks. Only the counted texts come together; one text per brand is
    then made inside the row.
    """
    values = value_rows(keep_active(attribute_rows(products), "id", input_filter))
    key = ["sku", "nome_produto", "atributo"]
    details = (
        values.where(F.lower("id") != K.BRAND_ATTRIBUTE)
        .withColumnRenamed("id", "atributo")
        .select(*key, "brand", "name", "updateDate", "value", "uom", "valueId", "subValue")
        .distinct()
    )
    counted = details.groupBy(*key, "brand", with_unit(F.col("value"), F.col("uom")).alias("texto")).agg(
        F.count(F.lit(1)).cast("int").alias("vezes")
    )
    grouped = counted.groupBy(*key).agg(
        F.collect_list(F.struct("brand", "texto", "vezes")).alias("textos")
    )

    def text_of(brand: Column) -> Column:
        own = F.filter("textos", lambda v: v["brand"] == brand)
        return joined(F.flatten(F.transform(own, lambda v: F.array_repeat(v["texto"], v["vezes"]))), separator)

    names = F.array_distinct(F.transform("textos", lambda v: v["brand"]))
    texts = F.array_distinct(F.transform(names, text_of))
    rows = grouped.select("sku", "nome_produto", "atributo", F.explode(texts).alias("valor"))
    brands = products.select(
        "sku",
        F.col("name").alias("nome_produto"),
        F.lit(K.BRAND_ROW_ATTRIBUTE).alias("atributo"),
        F.col("brand").alias("valor"),
    ).distinct()
    return rows.unionByName(brands).select(
        F.lit(origin).alias("origem"), load_time.alias("data_ingestao"), "*"
    )


def unpivot_by_family(
    df: DataFrame, key: str, origin: str, load_time: Column
) -> dict[str, DataFrame]:
    """The columns of a table as EAV rows, one frame per type family; the key is no attribute.

    Values keep all their digits, see ``stored_type``. Maps and structs are stored as JSON and
    types without a family as text, among the strings.
    """
    others = [f for f in df.schema if f.name != key and family_of(f.dataType) is None]
    as_text = {
        f.name: F.to_json(f"`{f.name}`")
        if f.dataType.typeName() in ("map", "struct", "variant")
        else F.col(f"`{f.name}`").cast("string")
        for f in others
    }
    df = df.withColumns(as_text) if as_text else df
    frames = {}
    for family, columns in columns_by_family(df, exclude=(key,)).items():
        stored = stored_type(family, [df.schema[c].dataType for c in columns])
        values = [F.col(c).cast(stored).alias(c) if stored else F.col(c) for c in columns]
        long = df.select(F.col(key).cast("string").alias("sku"), *values).unpivot(
            "sku", columns, "atributo", "valor"
        )
        frames[family] = long.select(
            F.lit(origin).alias("origem"),
            load_time.alias("data_ingestao"),
            "sku",
            F.lit("").alias("nome_produto"),
            "atributo",
            "valor",
        )
    return frames


def table_name(family: str) -> str:
    """Name of the EAV table that stores one type family."""
    return f"atributo_{family}"


def publish_families(
    df: DataFrame, key: str, origin: str, load_time: Column, root: str
) -> list[str]:
    """Unpivot a table and replace its slice in every typed table below ``root``; the tables written.

    All tables change in one commit or none does. Families that the source has no column of any
    more lose its slice as well.
    """
    frames = unpivot_by_family(df, key, origin, load_time)
    named = {table_name(family): frame for family, frame in frames.items()}
    return publish_slices(df.sparkSession, root, named, slices=[origin])


def wide_product(tables: list[DataFrame], requested: list[str]) -> DataFrame:
    """One row per sku, one text column per requested attribute holding its largest value.

    The typed tables are stacked and aggregated once; each type keeps its own value column until
    the maximum is known, so numbers compare as numbers. Attributes nobody asked for lose their
    name and value, so they cost nothing in the shuffle but keep the skus that have nothing else.
    """
    wanted = list(dict.fromkeys(a.lower() for a in requested))
    asked = F.col("atributo").isin(wanted)
    typed, value_columns = [], []
    for table in tables:
        column = f"valor_{family_of(table.schema['valor'].dataType)}"
        value_columns.append(column)
        named = table.select(F.trim("sku").alias("sku"), F.lower("atributo").alias("atributo"), "valor")
        typed.append(
            named.select(
                "sku",
                F.when(asked, F.col("atributo")).alias("atributo"),
                F.when(asked, F.col("valor")).alias(column),
            )
        )
    value_columns = sorted(set(value_columns))
    long = typed[0]
    for table in typed[1:]:
        long = long.unionByName(table, allowMissingColumns=True)
    text = pivot_max(long, ["sku"], "atributo", wanted, value_columns)
    return text.select("sku", *[F.col(f"`{a}`").cast("string").alias(a) for a in wanted])


def stack_eav(tables: list[DataFrame]) -> DataFrame:
    """Typed EAV tables as one table with text values."""
    columns = ["origem", "data_ingestao", "sku", "nome_produto", "atributo"]
    return union_tables([t.select(*columns, F.col("valor").cast("string")) for t in tables])


def unit_attributes(products: DataFrame) -> list[str]:
    """Lower-case ids of attributes that carry a unit; few, because each becomes a column."""
    ids = (
        value_rows(attribute_rows(products))
        .where(~is_blank(F.col("uom")))
        .select(F.lower("id").alias("id"))
        .distinct()
        .limit(MAX_UNIT_ATTRIBUTES + 1)
        .collect()
    )
    if len(ids) > MAX_UNIT_ATTRIBUTES:
        raise ValueError(f"more than {MAX_UNIT_ATTRIBUTES} attributes with a unit")
    return sorted(r.id for r in ids)


def unit_split(wide: DataFrame, unit_columns: list[str], separate: bool = True) -> DataFrame:
    """Lower-case the columns and, if ``separate``, move units to ``<column>_unid``."""
    units = {c.lower() for c in unit_columns}
    columns: list[Column] = []
    for name in wide.columns:
        lowered = name.lower()
        if separate and lowered in units:
            parts = F.split(F.col(name), " ")
            columns.append(F.get(parts, F.lit(0)).alias(lowered))
            columns.append(F.get(parts, F.lit(1)).alias(f"{lowered}_unid"))
        else:
            columns.append(F.col(name).alias(lowered))
    return wide.select(*columns)
