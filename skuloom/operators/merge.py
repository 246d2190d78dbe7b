"""Merges that rewrite only the key buckets they touch; all other files stay as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.functions.text import norm
from skuloom.operators.sync import update_matched, upsert_all
from skuloom.sources.snapshots import (
    Snapshot,
    Table,
    commit,
    current,
    merged_schema,
    read_parts,
    write_aside,
)


def bucket(keys: list[Column], buckets: int) -> Column:
    """Bucket of a key, without regard to case and outer blanks; null is a value like any other."""
    texts = [norm(k.cast("string")) for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets))


def _own(table: Table) -> Column:
    return bucket([F.col(k) for k in table.options["keys"]], table.options["buckets"])


def create_buckets(
    df: DataFrame, root: str, table: str, keys: list[str], buckets: int = 256
) -> Snapshot:
    """Write a table hashed into key buckets; a table of that name is replaced."""
    spark = df.sparkSession
    base = current(spark, root)
    options = {"keys": keys, "buckets": buckets}
    parts = write_aside(df, root, table, bucket([F.col(k) for k in keys], buckets))
    return commit(spark, root, base, {table: Table(df.schema, parts, options)})


def touched(rows: DataFrame, part: Column) -> list[str]:
    """Buckets of some rows: at most as many as the table has buckets reach the driver."""
    found = rows.select(part.cast("string").alias("balde")).distinct().collect()
    return sorted(r.balde for r in found)


def _rewrite(
    spark: SparkSession, root: str, base: Snapshot, table: str, names: list[str], rows: DataFrame
) -> Snapshot:
    """Commit new content for some buckets; the others are linked to the files they have."""
    old = base.tables[table]
    written = write_aside(rows, root, table, _own(old))
    kept = {p: f for p, f in old.parts.items() if p not in names}
    schema = merged_schema(old.schema, rows.schema)
    return commit(spark, root, base, {table: Table(schema, kept | written, old.options)})


def merge_buckets(
    spark: SparkSession,
    root: str,
    table: str,
    updates: DataFrame,
    keep: tuple[str, ...] = (),
) -> Snapshot:
    """``upsert_all`` into a bucketed table: the buckets of the updated keys are read and rewritten.

    The hash of the updated keys marks buckets in a set of at most as many bits as there are
    buckets, a Bloom filter of one hash function: a bucket that is not marked has no matching key
    and gets no new one. ``updates`` is read twice.
    """
    base = current(spark, root)
    own = base.tables[table]
    keys = own.options["keys"]
    names = touched(updates, bucket([F.col(k) for k in keys], own.options["buckets"]))
    if not names:
        return base
    rows = upsert_all(read_parts(spark, base, table, names), updates, keys, keep)
    return _rewrite(spark, root, base, table, names, rows)


def update_buckets(
    spark: SparkSession, root: str, table: str, source: DataFrame, source_key: str, column: str
) -> Snapshot:
    """``update_matched`` in a bucketed table with one key: only buckets with a match are rewritten.

    Buckets that the source's keys mark are looked through by key column alone first; those without
    a matching row stay as they are.
    """
    base = current(spark, root)
    own = base.tables[table]
    (key,) = own.options["keys"]
    source = source.where(F.col(column).isNotNull())
    marked = touched(source, bucket([F.col(source_key)], own.options["buckets"]))
    keys = source.select(norm(F.col(source_key)).alias("_chave")).distinct()
    rows = read_parts(spark, base, table, marked)
    matching = rows.withColumn("_chave", norm(F.col(key))).join(keys, "_chave", "left_semi")
    names = touched(matching, _own(own))
    if not names:
        return base
    target = read_parts(spark, base, table, names)
    return _rewrite(
        spark, root, base, table, names, update_matched(target, source, key, source_key, column)
    )
