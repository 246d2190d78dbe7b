"""Bring a target up to date: upserts, matched updates, three-way change sets, link tables.

Parquet tables cannot be changed in place, so every function returns the new content (or the
changes) and the caller writes it as a new version.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.functions.text import norm
from skuloom.operators.joins import lookup_join

INSERT, UPDATE, DELETE, SAME = "I", "U", "D", "="


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the largest by its other columns; copies meet before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_linha"))
    return best.select(*keys, "_linha.*").select(*df.columns)


def _match(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with each side's row as a struct: ``alvo`` and ``novo``.

    Full keys are unique: by contract in the target, by reduction in the source. Rows without a
    full key match nothing, so they take no part in the join and are all kept, copies too.
    """
    incomplete = reduce(or_, [F.col(k).isNull() for k in keys])
    old, new = F.struct(*target.columns).alias("alvo"), F.struct(*source.columns).alias("novo")
    left = target.where(~incomplete).select(*keys, old)
    right = one_per_key(source.where(~incomplete), keys).select(*keys, new)
    matched = left.join(right, keys, "full_outer")
    keyless_left = target.where(incomplete).select(*keys, old)
    keyless_right = source.where(incomplete).select(*keys, new)
    return matched.unionByName(keyless_left, allowMissingColumns=True).unionByName(
        keyless_right, allowMissingColumns=True
    )


def upsert_all(
    target: DataFrame, updates: DataFrame, keys: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Update all columns on a key match, insert the rest; ``keep`` columns survive a match."""
    matched = _match(target, updates, keys)
    columns = []
    for name in target.columns:
        old, new = F.col("alvo")[name], F.col("novo")[name]
        takes_new = F.col("novo").isNotNull()
        if name in keep:
            takes_new = takes_new & F.col("alvo").isNull()
        columns.append(F.when(takes_new, new).otherwise(old).alias(name))
    return matched.select(*columns)


def update_matched(
    target: DataFrame, source: DataFrame, target_key: str, source_key: str, column: str
) -> DataFrame:
    """Set one column where the normalised keys match; no row is added or removed."""
    values = (
        source.where(F.col(column).isNotNull())
        .groupBy(norm(F.col(source_key)).alias("_chave"))
        .agg(F.max(column).alias("_novo"))
    )
    joined = target.withColumn("_chave", norm(F.col(target_key))).join(values, "_chave", "left")
    return joined.select(
        *[
            F.coalesce("_novo", c).alias(c) if c == column else F.col(c)
            for c in target.columns
        ]
    )


def shop_urls(shop: DataFrame, suffix: str, url_column: str) -> DataFrame:
    """(sku, url) of the shop's entries; the reference id without ``suffix`` is the sku."""
    return shop.select(
        F.replace(F.trim("ProductRefId"), F.lit(suffix), F.lit("")).alias("sku"),
        F.col("DetailUrl").alias(url_column),
    )


def update_shop_urls(
    products: DataFrame, shop: DataFrame, suffix: str, url_column: str
) -> DataFrame:
    """Shop url of every product whose shop reference id, without ``suffix``, is its sku."""
    return update_matched(products, shop_urls(shop, suffix, url_column), "sku", "sku", url_column)


def sync_changes(
    target: DataFrame, stage: DataFrame, keys: list[str], load_time: Column
) -> DataFrame:
    """Every row of either side with its operation: insert, update, delete or unchanged.

    ``target`` has the columns of ``stage`` plus ``created_at`` and ``updated_at``. Inserts set
    the first, updates the second. Keys are unique on both sides, so no key can be hot.
    """
    matched = _match(target, stage, keys)
    old, new = F.col("alvo"), F.col("novo")
    values = [c for c in stage.columns if c not in keys]
    equal = F.lit(True)
    for name in values:
        equal = equal & old[name].eqNullSafe(new[name])
    operation = (
        F.when(old.isNull(), INSERT).when(new.isNull(), DELETE).when(equal, SAME).otherwise(UPDATE)
    )
    rows = matched.withColumn("op", operation)
    op = F.col("op")
    return rows.select(
        "op",
        *keys,
        *[F.when(op == DELETE, old[c]).otherwise(new[c]).alias(c) for c in values],
        F.when(op == INSERT, load_time).otherwise(old["created_at"]).alias("created_at"),
        F.when(op == UPDATE, load_time).otherwise(old["updated_at"]).alias("updated_at"),
    )


def sync_apply(changes: DataFrame) -> DataFrame:
    """Target content after the changes."""
    return changes.where(F.col("op") != DELETE).drop("op")


def sync_by_owner(
    target: DataFrame, stage: DataFrame, owner: str, match: list[str]
) -> DataFrame:
    """Change set of detail rows whose presence is decided by their owner.

    Rows of owners missing in the stage are deleted, rows of owners missing in the target are
    inserted, and rows that match on all ``match`` columns take the staged values. An owner may
    hold most of the rows, so owners are matched through spread lookups.
    """
    staged_owners = stage.select(owner).distinct().withColumn("_presente", F.lit(True))
    target_owners = target.select(owner).distinct()
    values = [c for c in stage.columns if c not in match]
    fresh = one_per_key(stage, match).select(*match, F.struct(*values).alias("novo"))
    seen = lookup_join(target, staged_owners, [owner], "left").join(fresh, match, "left")
    new = F.col("novo")
    kept = seen.select(
        F.when(F.col("_presente").isNull(), DELETE).when(new.isNotNull(), UPDATE).otherwise(SAME).alias("op"),
        *match,
        *[F.when(new.isNotNull(), new[c]).otherwise(F.col(c)).alias(c) for c in values],
    )
    inserts = lookup_join(stage, target_owners, [owner], "left_anti").distinct()
    return kept.unionByName(inserts.withColumn("op", F.lit(INSERT)))


def link_rebuild(images: DataFrame, products: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct (image, product) pairs that share a sku and are not linked yet."""
    named = images.where(F.col("nome_arquivo").isNotNull()).select(
        "sku", F.col("id").alias("produto_imagem_id")
    )
    owners = products.select("sku", F.col("id").alias("produto_id"))
    pairs = (
        lookup_join(named, owners, ["sku"], "inner")
        .select("produto_imagem_id", "produto_id")
        .distinct()
    )
    return pairs.join(existing, ["produto_imagem_id", "produto_id"], "left_anti")
