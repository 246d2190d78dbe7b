"""Pivot to one column per requested name, keeping the largest value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many aggregates one row of buffers is too wide for generated code.
MAX_CONDITIONAL = 64


def names_found(df: DataFrame, name: str) -> list[str]:
    """The names that a pivot gives a column each, sorted; null is no name.

    They decide the schema, so they must reach the driver. Copies are dropped on the map side, so
    as many rows arrive as the result has columns.
    """
    found = df.where(F.col(name).isNotNull()).select(name).distinct().collect()
    return sorted(r[0] for r in found)


def pivot_max(
    df: DataFrame, keys: list[str], name: str, names: list[str], values: list[str]
) -> DataFrame:
    """Largest value of each name per key; with several value columns the first filled, as text.

    Up to ``MAX_CONDITIONAL`` aggregates the pivot is one conditional aggregation: rows of a key
    meet in one wide row before the single shuffle. Beyond that the rows are reduced per key and
    name first and then pivoted, which takes a second shuffle but a narrow buffer. Spark's pivot does
    so on its own; only several value columns need to be reduced before they are merged.
    """

    def merged(columns: list[Column]) -> Column:
        if len(columns) == 1:
            return columns[0]
        return F.coalesce(*[c.cast("string") for c in columns])

    if len(names) * len(values) <= MAX_CONDITIONAL:
        cells = [
            merged([F.max(F.when(F.col(name) == n, F.col(v))) for v in values]).alias(n)
            for n in names
        ]
        return df.groupBy(*keys).agg(*cells)
    if len(values) == 1:
        return df.select(*keys, name, *values).groupBy(*keys).pivot(name, names).agg(F.max(values[0]))
    best = df.groupBy(*keys, name).agg(*[F.max(v).alias(v) for v in values])
    single = best.select(*keys, name, merged([F.col(v) for v in values]).alias("_valor"))
    return single.groupBy(*keys).pivot(name, names).agg(F.max("_valor"))
