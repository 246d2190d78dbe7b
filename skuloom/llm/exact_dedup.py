"""Exact deduplication with frequent digests split off before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuloom.llm.common import (
    BLANKS,
    digest,
    discard,
    fresh,
    may_hold,
    quoted,
    reach_workers,
    stored,
    text_of,
)

#: Counters of the frequent-item summary: every digest of more than 1 / (COUNTERS + 1) of all rows
#: is found. The broadcast holds at most this many winners.
COUNTERS = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def _summaries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over one partition: at most ``counters`` digests, each with a lower count.

    A batch is counted at once; while more than ``counters`` digests remain, the next largest
    count beyond them is taken from all, which is the same as as many single decrements.
    """
    held: dict[str, int] = {}
    for batch in batches:
        for pair in pc.value_counts(batch.column(0)).to_pylist():
            held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = {k: n - cut for k, n in held.items() if n > cut}
    if held:
        yield pa.RecordBatch.from_pydict(
            {"text_sha256": list(held), "least": pa.array(held.values(), pa.int64())}
        )


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them all of more than 1/(counters + 1) of the rows.

    Partition summaries are added up by digest; taking the (counters + 1)-th largest sum off all
    merges them under the same bound. Only that many sums meet in one place.
    """
    parts = rows.select("text_sha256").mapInArrow(
        lambda batches: _summaries(batches, counters), "text_sha256 string, least bigint"
    )
    sums = parts.groupBy("text_sha256").agg(F.sum("least").alias("least"))
    top = sums.orderBy(F.desc("least"), "text_sha256").limit(counters + 1)
    rank = F.row_number().over(Window.orderBy(F.desc("least"), "text_sha256"))
    last = F.max(F.when(F.col("rank") == counters + 1, F.col("least"))).over(
        Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranked = top.withColumn("rank", rank).withColumn("cut", F.coalesce(last, F.lit(0)))
    return ranked.where("rank <= %d and least > cut" % counters).select("text_sha256")


def _first(order: Column) -> Column:
    return F.min(order).alias("first")


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("_row"))


def _digest_rows(docs: DataFrame, counters: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Digest rows of all documents, the frequent digests, and the winner and size of each of those."""
    reach_workers(docs.sparkSession)
    rows = stored(
        docs.select(
            docs["doc_id"],
            digest(normalised(text_of(docs))).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "digests",
    )
    candidates = stored(frequent_digests(rows, counters), "frequent")
    winners = stored(
        rows.join(F.broadcast(candidates), "text_sha256")
        .groupBy("text_sha256")
        .agg(_first(_order()), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )
    return rows, candidates, winners


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: the row its group keeps, the group's size, whether it stays.

    Texts are equal when they agree after each run of blanks has become one space; null is empty.
    The row with the smallest ``doc_id`` stays, null ids last; of rows that tie, exactly one.
    Frequent digests are counted exactly, and their winners (at most ``counters``) are broadcast, so
    that their rows never move; all other rows meet in one shuffle on the digest, and none of those
    groups has more than 1/(counters + 1) of the rows. An empty table gives no rows.
    """
    rows, candidates, winners = _digest_rows(docs, counters)
    hot = rows.join(F.broadcast(winners), "text_sha256")
    cold = rows.join(F.broadcast(candidates), "text_sha256", "left_anti")
    group = Window.partitionBy("text_sha256")
    cold = cold.withColumn("first", F.min(_order()).over(group)).withColumn(
        "group_size", F.count(F.lit(1)).over(group)
    )
    both = hot.select(cold.columns).unionByName(cold)
    return both.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("first._row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that ``exact_groups`` keeps, all columns; of tied rows any one stays.

    Null texts count as empty; an empty table gives no rows; long texts are read for their digest
    like others. Rows of a frequent digest go where they are read unless they have the broadcast
    winner's id. Of the rest, texts without a copy stay where they are: a filter of fixed size,
    made from the digests that occur twice or more, lets only (and all) others through to the
    shuffle, in which each task sends at most one row per digest.
    """
    rows, candidates, winners = _digest_rows(docs, counters)
    several = (
        rows.join(F.broadcast(candidates), "text_sha256", "left_anti")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("text_sha256")
        .unionByName(winners.where("group_size > 1").select("text_sha256"))
    )
    several = stored(several, "copied-digests")
    discard(rows)
    key, own, shared = (fresh(docs, c) for c in ("_digest", "_own", "_shared"))
    hot = winners.select(F.col("text_sha256").alias(key), F.struct("first.doc_id").alias(own))
    keyed = docs.withColumn(key, digest(normalised(text_of(docs))))
    left = keyed.join(F.broadcast(hot), key, "left").where(
        F.col(own).isNull() | docs["doc_id"].eqNullSafe(F.col(f"{own}.doc_id"))
    )
    left = may_hold(left, F.col(key), several, shared)
    alone = left.where(~F.col(shared)).select(quoted(docs))
    order = F.struct(docs["doc_id"].isNull().alias("n"), docs["doc_id"].alias("d"))
    chosen = (
        left.where(F.col(shared))
        .groupBy(key)
        .agg(F.min_by(F.struct(*quoted(docs)), order).alias(own))
        .select(f"{own}.*")
    )
    return alone.unionByName(chosen)
