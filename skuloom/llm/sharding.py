"""Sharding by jump consistent hashing, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import in_runs, running_starts, stored, text_of

#: Multiplier of the 64-bit linear congruential generator of the published algorithm (fixed value).
MULTIPLIER = 2862933555777941757
_LOW32 = (1 << 32) - 1
#: Parts in which a shard is numbered.
BLOCKS = 4096


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64, on 32-bit halves so that no product overflows."""
    a, b = MULTIPLIER >> 32, MULTIPLIER & _LOW32
    b_hi, b_lo = b >> 16, b & 0xFFFF

    def times_b(x: Column) -> tuple[Column, Column]:
        """Low 32 bits and the rest of x * b, for x below 2**32."""
        upper = x * F.lit(b_hi)
        lower = x * F.lit(b_lo) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16)
        rest = F.shiftright(lower, 32) + F.shiftright(upper, 16)
        return lower.bitwiseAND(F.lit(_LOW32)), rest

    def low(x: Column, factor: int) -> Column:
        """Low 32 bits of x * factor, for both below 2**32."""
        part = (x * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF))
        return (x * F.lit(factor & 0xFFFF) + F.shiftleft(part, 16)).bitwiseAND(F.lit(_LOW32))

    low_b, carry = times_b(lo)
    plus_one = low_b + F.lit(1)
    new_lo = plus_one.bitwiseAND(F.lit(_LOW32))
    new_hi = carry + F.shiftright(plus_one, 32) + low(hi, b) + low(lo, a)
    return new_hi.bitwiseAND(F.lit(_LOW32)), new_lo


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a key among ``shards``: 0 to shards - 1, decided by key and count alone.

    The key's text is hashed to 64 bits first, so any type serves; null is a key of its own. With
    one shard more, a key stays where it is or goes to the new shard. The fold takes as many steps
    as there are shards.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    name = F.md5(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null")))
    half = lambda at: F.conv(F.substring(name, at, 8), 16, 10).cast("bigint")
    begin = F.struct(
        half(1).alias("hi"),
        half(9).alias("lo"),
        F.lit(-1).cast("bigint").alias("at"),
        F.lit(0).cast("bigint").alias("next"),
    )

    def jump(state: Column, _: Column) -> Column:
        hi, lo = _step(state["hi"], state["lo"])
        top = F.shiftright(hi, 1) + F.lit(1)
        there = (state["next"] + F.lit(1)) * (F.lit(float(1 << 31)) / top.cast("double"))
        return F.when(state["next"] >= F.lit(shards), state).otherwise(
            F.struct(
                hi.alias("hi"),
                lo.alias("lo"),
                state["next"].alias("at"),
                F.floor(there).cast("bigint").alias("next"),
            )
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), begin, jump)["at"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every document, and its shard when one more is appended.

    Law ``key``: ``doc_id`` and the number of shards decide. ``size`` is the text's UTF-8 bytes
    plus 1 (null text: 1), ``text_crc32`` the unsigned checksum of the same bytes. Slots of a shard
    run gaplessly from 0 in the order of (block of a hash, doc_id, size, checksum). Null ids are one
    key. Equal rows are counted before the shuffle, numbered in runs of 10,000 that lie in blocks of
    their own, and laid out again run by run, so copies cannot fill a task. Null and empty texts
    differ only in nothing: both have size 1. Long texts are read once for their size and checksum.
    Extra columns are not read. An empty table gives no rows.
    """
    text = text_of(docs)
    counted = (
        docs.select(
            docs["doc_id"],
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    rows = (
        in_runs(counted, "copies", "run")
        .withColumn("shard", jump_shard(F.col("doc_id"), shards))
        .withColumn("grown_shard", jump_shard(F.col("doc_id"), shards + 1))
        .withColumn(
            "block",
            F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "run"), F.lit(BLOCKS)).cast("int"),
        )
    )
    rows = stored(rows, "shards")
    placed = running_starts(rows, ["shard"], "block", ["doc_id", "size", "text_crc32", "run"], "copies")
    slot = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        slot.alias("slot"),
        "grown_shard",
    )
