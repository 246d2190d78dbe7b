"""Options of relational reads and writes; credentials come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    query: str,
    connection: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a query that the database runs, read in ``partitions`` parallel ranges.

    Spark accepts a partition column only for a table, so the query is passed as a derived table.
    """
    options = {
        "url": url,
        "dbtable": f"({query.strip().rstrip(';').rstrip()}) q",
        "fetchsize": str(fetch_size),
        **connection,
    }
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its partition column")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def jdbc_write_options(
    url: str,
    table: str,
    connection: dict[str, str],
    batch_size: int = 10_000,
    connections: int = 16,
) -> dict[str, str]:
    """Options of a staging overwrite that keeps the table and its grants."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        "truncate": "true",
        **connection,
    }


def read_query(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_staging(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("overwrite").save()
