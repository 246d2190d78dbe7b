"""Type families of the entity-attribute-value store and types named by the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuloom import constants as K

# Spark types of each family and the type a family is stored as.
FAMILY_TYPES = {
    "string": (T.StringType, T.CharType, T.VarcharType),
    "bigint": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "decimal": (T.DecimalType,),
    "float": (T.FloatType, T.DoubleType),
    "boolean": (T.BooleanType,),
    "binary": (T.BinaryType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "date": (T.DateType,),
    "array": (T.ArrayType,),
    "void": (T.NullType,),
}
STORED_AS = {"string": "string", "bigint": "bigint", "float": "double"}


def family_of(data_type: T.DataType) -> str | None:
    for family, members in FAMILY_TYPES.items():
        if isinstance(data_type, members):
            return family
    return None


def stored_type(family: str, types: list[T.DataType]) -> str | None:
    """The one type that holds every value of a family unchanged; None where they are alike.

    Decimals get the digits before and after the point that the widest columns need, and become
    text where 38 digits cannot hold both. Arrays of several element types become arrays of text.
    """
    if family == "decimal":
        scale = max(t.scale for t in types)
        digits = scale + max(t.precision - t.scale for t in types)
        return f"decimal({digits},{scale})" if digits <= 38 else "string"
    if family == "array" and len({t.elementType.simpleString() for t in types}) > 1:
        return "array<string>"
    return STORED_AS.get(family)


def columns_by_family(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Column names grouped by type family; columns of other types are left out."""
    groups: dict[str, list[str]] = {}
    for field in df.schema.fields:
        family = family_of(field.dataType)
        if family and field.name not in exclude:
            groups.setdefault(family, []).append(field.name)
    return groups


def catalogue_type(type_name: Column, precision: Column) -> Column:
    """Spark type of a catalogue entry, e.g. ``decimal`` and ``(18,2)`` give ``decimal (18,2)``."""
    name = F.lower(F.trim(type_name))
    spark_name = F.coalesce(name, F.lit("string"))
    for source, target in K.CATALOGUE_TYPES.items():
        spark_name = F.when(name == source, F.lit(target)).otherwise(spark_name)
    return F.concat_ws(" ", spark_name, precision)
