"""Completeness: which required attributes of a product are filled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import decimal_comma, norm, yes_no
from skuloom.operators.joins import lookup_join


#: Bits of one bitmap word, and groups that attribute names are numbered in.
_BITS, _GROUPS = 62, 4


def on_site(value: Column) -> Column:
    """The usual site rule: the product is flagged as shown."""
    return F.lower(value) == K.SITE_FLAG_VALUE


def shown_skus(eav: DataFrame, site_rule: Callable[[Column], Column] = on_site) -> DataFrame:
    """Skus whose site flag passes the rule."""
    flags = eav.where(F.lower("atributo") == K.SITE_FLAG_ATTRIBUTE)
    return flags.where(site_rule(F.col("valor"))).select("sku").distinct()


def required_attributes(nodes: DataFrame, required: bool | None = True) -> DataFrame:
    """Distinct (node, attribute, required) rules that take part in completeness."""
    field = F.lower("atributo")
    rules = nodes.select("_id", F.inline("attributes")).select(
        F.col("_id").alias("no"), F.col("field").alias("atributo"), F.col("required").alias("obrigatorio")
    )
    kept = rules.where(
        ~field.like(K.EXCLUDED_ATTRIBUTE_PATTERN) & (field != K.EXCLUDED_ATTRIBUTE)
    )
    if required is not None:
        kept = kept.where(F.col("obrigatorio").eqNullSafe(F.lit(required)))
    return kept.distinct()


def _steps(primary: DataFrame, shown: DataFrame, levels: int) -> DataFrame:
    """(sku, node) for the nodes of the path of every product that is shown."""
    nodes = F.explode(F.slice("hierarchies.primary", 1, levels)).alias("no")
    return primary.select("sku", nodes).where(F.col("no").isNotNull()).join(shown, "sku", "left_semi")


def completeness(
    primary: DataFrame,
    nodes: DataFrame,
    eav: DataFrame,
    required: bool | None = True,
    levels: int = K.COMPLETENESS_LEVELS,
    site_rule: Callable[[Column], Column] = on_site,
) -> DataFrame:
    """One row per site product and attribute asked for on its path, with the value found.

    ``required`` None takes the optional attributes too; ``site_rule`` decides which values of the
    site flag count.

    The path is expanded once for all levels. The upper nodes are shared by nearly all products,
    so the rules are joined as a spread lookup. The attribute store is reduced to the attributes
    that some rule asks for, then to one row per product and attribute, before it is shuffled to
    the join.
    """
    rules = required_attributes(nodes, required)
    steps = _steps(primary, shown_skus(eav, site_rule), levels)
    asked = (
        lookup_join(steps, rules, ["no"], "inner")
        .select("sku", "atributo", "obrigatorio")
        .distinct()
        .withColumns({"_sku": norm(F.col("sku")), "_atributo": norm(F.col("atributo"))})
    )
    names = rules.select(norm(F.col("atributo")).alias("_atributo")).distinct()
    stored = eav.select(
        norm(F.col("sku")).alias("_sku"), norm(F.col("atributo")).alias("_atributo"), "atributo", "valor"
    )
    found = (
        lookup_join(stored, names, ["_atributo"], "left_semi")
        .groupBy("_sku", "_atributo")
        .agg(F.max("atributo").alias("atributo_golden_record"), F.max("valor").alias("valor"))
    )
    return asked.join(found, ["_sku", "_atributo"], "left").select(
        "sku",
        F.col("atributo").alias("atributo_hierarquia"),
        yes_no(F.col("obrigatorio").eqNullSafe(F.lit(True))).alias("obrigatorio"),
        "atributo_golden_record",
        "valor",
        yes_no(F.col("atributo_golden_record").isNotNull()).alias("preenchido"),
    )


def numbered_attributes(rules: DataFrame) -> DataFrame:
    """(attribute, word, bit): a bit of its own for every attribute that some rule names.

    Names are numbered within a few hash groups, so no window spans them all; a word belongs to one
    group.
    """
    names = rules.select("atributo").distinct()
    names = names.withColumn("_grupo", F.pmod(F.xxhash64("atributo"), F.lit(_GROUPS)))
    rank = F.row_number().over(Window.partitionBy("_grupo").orderBy("atributo")) - 1
    ranked = names.withColumn("_numero", rank)
    word = (F.floor(F.col("_numero") / _BITS) * _GROUPS + F.col("_grupo")).cast("int")
    bit = F.expr(f"shiftleft(1L, CAST(_numero % {_BITS} AS INT))")
    return ranked.select("atributo", word.alias("palavra"), bit.alias("bit"))


def completeness_counts(
    primary: DataFrame,
    nodes: DataFrame,
    eav: DataFrame,
    required: bool | None = None,
    levels: int = K.COMPLETENESS_LEVELS,
    site_rule: Callable[[Column], Column] = on_site,
) -> DataFrame:
    """(sku, obrigatorio, Sim, Não): how many attributes asked for are filled, from bitmaps.

    The same counts as those of the rows of ``completeness``, without these rows. Each node has one
    bitmap of the attributes it asks for; bitmaps are joined to the paths and rolled down by
    bitwise or, and the filled ones are the common bits with the product's own bitmap. What is
    shuffled is one word per product and up to 62 attributes.
    """
    rules = required_attributes(nodes, required)
    numbers = numbered_attributes(rules)
    node_bits = (
        rules.join(numbers, "atributo")
        .groupBy("no", "obrigatorio", "palavra")
        .agg(F.bit_or("bit").alias("pedidos"))
    )
    asked = (
        lookup_join(_steps(primary, shown_skus(eav, site_rule), levels), node_bits, ["no"], "inner")
        .groupBy("sku", "obrigatorio", "palavra")
        .agg(F.bit_or("pedidos").alias("pedidos"))
        .withColumn("_sku", norm(F.col("sku")))
    )
    named = numbers.select(norm(F.col("atributo")).alias("_atributo"), "palavra", "bit")
    stored = eav.select(norm(F.col("sku")).alias("_sku"), norm(F.col("atributo")).alias("_atributo"))
    filled = (
        lookup_join(stored, named, ["_atributo"], "inner")
        .groupBy("_sku", "palavra")
        .agg(F.bit_or("bit").alias("presentes"))
    )
    common = F.col("pedidos").bitwiseAND(F.coalesce("presentes", F.lit(0).cast("long")))
    both = asked.join(filled, ["_sku", "palavra"], "left").select(
        "sku",
        yes_no(F.col("obrigatorio").eqNullSafe(F.lit(True))).alias("obrigatorio"),
        F.bit_count("pedidos").alias("total"),
        F.bit_count(common).alias(K.YES),
    )
    return both.groupBy("sku", "obrigatorio").agg(
        F.sum(K.YES).alias(K.YES), (F.sum("total") - F.sum(K.YES)).alias(K.NO)
    )


def _shares(matrix: DataFrame, groups: list[str]) -> DataFrame:
    """Filled and missing counts of each group beside its total, in one aggregation.

    ``matrix`` holds rows of ``completeness`` or of ``completeness_counts``.
    """
    states = (K.YES, K.NO)
    counts = {s: F.sum(s) for s in states}
    if "preenchido" in matrix.columns:
        counts = {s: F.count_if(F.col("preenchido") == s) for s in states}
    counted = matrix.groupBy(*groups).agg(*[n.alias(s) for s, n in counts.items()])
    counted = counted.withColumn("total", F.col(K.YES) + F.col(K.NO))
    rows = F.array(
        *[F.struct(F.lit(s).alias("preenchido"), F.col(s).alias("contagem")) for s in states]
    )
    present = F.filter(rows, lambda row: row["contagem"] > 0)
    return counted.select(*groups, "total", F.inline(present)).select(
        *groups, "preenchido", "contagem", "total"
    )


def completeness_share(matrix: DataFrame) -> DataFrame:
    """Share of filled and missing attributes; the ratio is rounded before it becomes percent."""
    ratio = (F.col("contagem") / F.col("total")).cast("decimal(18,2)")
    return _shares(matrix, ["obrigatorio"]).withColumn(
        "percentual", (ratio * 100).cast("decimal(18,2)")
    )


def completeness_by_sku(matrix: DataFrame) -> DataFrame:
    """Share per product as text with a decimal comma; the percentage itself is rounded."""
    percent = ((F.col("contagem") / F.col("total")) * 100).cast("decimal(18,2)")
    return _shares(matrix, ["sku", "obrigatorio"]).withColumn("percentual", decimal_comma(percent))
