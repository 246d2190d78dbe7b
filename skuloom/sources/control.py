"""Control tables kept as sheets: each is loaded under the name of the table it feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skuloom.sources.schemas import CONTROL_TABLES
from skuloom.sources.tables import overwrite_table


def load_control_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A control sheet exported as CSV, read with the schema of the table it is named after."""
    if name not in CONTROL_TABLES:
        raise ValueError(f"unknown control table {name!r}; known: {sorted(CONTROL_TABLES)}")
    return spark.read.schema(CONTROL_TABLES[name]).option("header", True).csv(path)


def refresh_control_table(spark: SparkSession, sheet: str, name: str, root: str) -> str:
    """Replace the control table ``name`` below ``root`` with the content of its sheet."""
    return overwrite_table(load_control_table(spark, sheet, name), f"{root.rstrip('/')}/{name}")
