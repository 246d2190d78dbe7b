"""Parquet tables: scans, overwrite, append with new columns, slice replacement, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.functions.text import norm
from skuloom.session import new_dir


def read_table(
    spark: SparkSession, path: str, evolve: bool = False, schema: str | None = None
) -> DataFrame:
    """Parquet folder; ``evolve`` merges the schemas of all its files.

    A narrower ``schema`` reads only the nested fields it names: expanding an array of structs
    would otherwise read every field of the struct.
    """
    reader = spark.read.option("mergeSchema", evolve)
    return (reader.schema(schema) if schema else reader).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_version(df: DataFrame, label: str) -> str:
    """Write to a new folder and return it.

    A rewrite that reads its own target must not overwrite it in place; the caller switches to
    the returned path, so readers of the old one are never cut off.
    """
    return overwrite_table(df, new_dir(df.sparkSession, label))


def append_evolving(df: DataFrame, path: str) -> str:
    """Append rows whose columns may be new; read back with ``read_table(evolve=True)``."""
    df.write.mode("append").parquet(path)
    return path


def replace_slice(
    df: DataFrame, path: str, slice_column: str = "origem", slices: list[str] | None = None
) -> str:
    """Replace the slices present in ``df``; the other slices stay as they are.

    ``slices`` names the sources that were loaded: one of them without rows in ``df`` loses the
    rows it had. Their folders go only after the write has succeeded. Rows are not gathered by
    slice before the write: one source may hold most rows, so every task writes its own file into
    the slice folder. The rebalance hint joins small files and splits large ones.
    """
    emptied = set(slices or ())
    if emptied:
        found = df.where(F.col(slice_column).isin(sorted(emptied))).select(slice_column).distinct()
        emptied -= {r[0] for r in found.collect()}
    (
        df.hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(slice_column)
        .parquet(path)
    )
    for name in sorted(emptied):
        _remove_slice(df.sparkSession, path, slice_column, name)
    return path


def _remove_slice(spark: SparkSession, path: str, column: str, name: str) -> None:
    """Delete the folder of one slice, through the store that holds the table."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={escape(name)}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables with the same columns, each table read once."""
    return reduce(lambda left, right: left.unionByName(right), tables)


def tables_like(spark: SparkSession, pattern: str, exclude: str | None = None) -> list[str]:
    """Catalog tables and views whose name matches a ``*`` pattern, in name order."""
    names = {t.name for t in spark.catalog.listTables(pattern=pattern)}
    if exclude:
        names -= {t.name for t in spark.catalog.listTables(pattern=exclude)}
    return sorted(names)


def brand_view(
    df: DataFrame,
    brand: str,
    requested: list[str],
    leading: list[str],
    fixed: tuple[str, ...] = (),
    brand_column: str = "marca",
) -> DataFrame:
    """Rows of one brand: the leading columns, then the requested ones outside the fixed set."""
    hidden = set(leading) | set(fixed) | {brand_column}
    rest = [c for c in requested if c not in hidden]
    return df.where(norm(F.col(brand_column)) == brand.lower()).select(*leading, *rest)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
