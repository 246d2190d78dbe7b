"""Nested document collections from JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.sources.schemas import COLLECTIONS


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str,
    required: str,
    columns: list[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Documents of ``path`` that have the ``required`` field, projected to ``columns``.

    One document per line lets Spark split the files; ``multiline`` is for files that hold one
    JSON array, each of which is then a single task.
    """
    documents = spark.read.schema(schema).option("multiLine", multiline).json(path)
    kept = documents.where(F.col(required).isNotNull())
    return kept.select(*columns) if columns else kept


def read_collection(
    spark: SparkSession, path: str, collection: str, multiline: bool = False
) -> DataFrame:
    """A collection known by name, with its own schema and presence rule."""
    schema, required = COLLECTIONS[collection]
    return read_documents(spark, path, schema, required, multiline=multiline)


def document_timestamp(field: str) -> F.Column:
    """Timestamp of an extended-JSON date such as ``{"$date": "2024-01-01T00:00:00Z"}``."""
    text = F.coalesce(F.get_json_object(F.col(field), "$.$date"), F.col(field))
    return text.try_cast("timestamp")
