"""Surrogate ids."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.session import small_rows
from skuloom.sources.tables import read_table, write_version

#: Bits of a hash id: 15 hexadecimal digits.
HASH_BITS = 60
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def surrogate_id(df: DataFrame, order: list[str], output: str = "id") -> DataFrame:
    """Rows numbered 1..n in the given order, without a single-task window; copies keep their ids.

    Rows are range-partitioned and sorted by ``order`` and then by all other columns, so ties are
    settled and equal keys can still be split. The sorted partitions are written as Parquet, because
    range bounds are sampled anew on every run; the counts are read from the row numbers alone. Only
    one count per partition reaches the driver, where they become offsets; that bound makes them
    safe to broadcast.
    """
    keys = [*order, *[c for c in df.columns if c not in order]]
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    marked = sorted_rows.withColumn("_linha", F.monotonically_increasing_id())
    numbered = read_table(df.sparkSession, write_version(marked, "numeros"), schema=marked.schema)
    part = F.shiftright("_linha", _ROW_BITS)
    counts = sorted(
        (r.parte, r.n) for r in numbered.groupBy(part.alias("parte")).count().toDF("parte", "n").collect()
    )
    starts = accumulate((n for _, n in counts), initial=0)
    offsets = small_rows(
        df.sparkSession, [(p, s) for (p, _), s in zip(counts, starts)], "_parte long, _inicio long"
    )
    row = F.col("_linha").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        numbered.withColumn("_parte", part)
        .join(F.broadcast(offsets), "_parte")
        .select(*df.columns, (F.col("_inicio") + row + 1).alias(output))
    )


def surrogate_increment(
    existing: DataFrame, df: DataFrame, keys: list[str], order: list[str], output: str = "id"
) -> DataFrame:
    """Rows of ``df`` with the ids that their keys have; new keys are numbered behind the largest.

    Ids never change or come back: a key that is gone keeps its number, and one that returns gets it
    again. ``existing`` has each key once with its id. Null is a key like any other.
    """
    known = existing.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(output).alias("_id"))
    same = None
    for k in keys:
        equal = df[k].eqNullSafe(known[f"_{k}"])
        same = equal if same is None else same & equal
    kept = df.join(known, same, "inner").select(*df.columns, F.col("_id").alias(output))
    fresh = df.join(known, same, "left_anti")
    new_keys = fresh.select(*dict.fromkeys([*keys, *order])).dropDuplicates(keys)
    last = existing.agg(F.coalesce(F.max(output), F.lit(0))).first()[0]
    numbered = surrogate_id(new_keys, order, output).select(
        *[F.col(k).alias(f"_{k}") for k in keys], (F.col(output) + F.lit(last)).alias(output)
    )
    same = None
    for k in keys:
        equal = fresh[k].eqNullSafe(numbered[f"_{k}"])
        same = equal if same is None else same & equal
    added = fresh.join(numbered, same, "inner").select(*df.columns, output)
    return kept.unionByName(added)


def _digest_id(columns: list[str], bits: int, probe: Column | None = None) -> Column:
    """The first ``bits`` of an MD5 over the columns, each with its length, so none runs into the next."""
    texts = [F.col(c).cast("string") for c in columns]
    named = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    if probe is not None:
        named.append(F.when(probe > 0, F.concat(F.lit("#"), probe)).otherwise(F.lit("")))
    head = F.conv(F.substring(F.md5(F.concat(*named)), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    return F.shiftright(head, HASH_BITS - bits)


def hash_id(df: DataFrame, columns: list[str], output: str = "id", bits: int = HASH_BITS) -> DataFrame:
    """Hash id from a digest that every engine computes alike: stable between runs, no shuffle."""
    return df.withColumn(output, _digest_id(columns, bits))


def resolved_id(
    df: DataFrame, columns: list[str], output: str = "id", bits: int = HASH_BITS
) -> DataFrame:
    """Hash ids without collisions: each key has an id of its own, decided by the set of keys.

    Of the keys that hash alike the smallest keeps the id; the others probe on with their attempt
    hashed along, again the smallest first, until all have an id that nobody has. Only keys that
    collided take part in a further round, and the loop ends where there are none, which for the
    full width is after the first look. More keys than ids are refused.
    """
    spark = df.sparkSession
    keys = df.select(*columns).distinct().withColumn("_vez", F.lit(0))
    settled, waiting = None, keys.withColumn(output, _digest_id(columns, bits))
    if keys.count() > 1 << bits:
        raise ValueError(f"more keys than {bits} bits can name")
    while True:
        order = F.struct(*columns)
        winners = waiting.groupBy(output).agg(F.min(order).alias("_menor"), F.count(F.lit(1)).alias("_n"))
        if settled is not None:
            winners = winners.join(settled.select(output), output, "left_anti")
        won = winners.select("_menor.*", output)
        round_ = read_table(spark, write_version(won, "ids"), schema=won.schema)
        settled = round_ if settled is None else settled.unionByName(round_)
        tried = waiting.select(*columns, "_vez", F.col(output).alias("_antes"))
        mine = round_.select(*[F.col(c).alias(f"_{c}") for c in columns])
        same = F.lit(True)
        for c in columns:
            same = same & tried[c].eqNullSafe(mine[f"_{c}"])
        lost = tried.join(mine, same, "left_anti").select(*columns, (F.col("_vez") + 1).alias("_vez"))
        lost = lost.withColumn(output, _digest_id(columns, bits, F.col("_vez")))
        waiting = read_table(spark, write_version(lost, "ids"), schema=lost.schema)
        if waiting.isEmpty():
            break
    known = settled.select(*[F.col(c).alias(f"_{c}") for c in columns], output)
    same = F.lit(True)
    for c in columns:
        same = same & df[c].eqNullSafe(known[f"_{c}"])
    return df.join(known, same, "inner").select(*df.columns, output)


def id_collisions(df: DataFrame, columns: list[str], output: str = "id") -> DataFrame:
    """Ids shared by different keys; empty when the hash id is safe to use."""
    return (
        df.select(output, *columns).distinct().groupBy(output).count().where(F.col("count") > 1)
    )
