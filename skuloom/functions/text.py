"""Text rules as column expressions; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K


def is_blank(column: Column) -> Column:
    """Null or nothing but spaces."""
    return column.isNull() | (F.trim(column) == "")


def norm(column: Column) -> Column:
    """Form under which two texts count as equal."""
    return F.lower(F.trim(column))


def flag(column: Column) -> Column:
    """Control-table flag (number, boolean or word) as a boolean that is never null."""
    return F.coalesce(norm(column.cast("string")).isin(*K.TRUE_WORDS), F.lit(False))


def yes_no(condition: Column) -> Column:
    return F.when(condition, K.YES).otherwise(K.NO)


def with_unit(value: Column, unit: Column) -> Column:
    """``12`` and ``cm`` give ``12 cm``; a blank unit leaves the value alone."""
    return F.when(is_blank(unit), value).otherwise(F.concat(value, F.lit(" "), unit))


def fold_accents(column: Column) -> Column:
    return F.translate(F.lower(column), K.ACCENTED, K.UNACCENTED)


def without(column: Column, *parts: str) -> Column:
    """Delete every occurrence of the given texts."""
    for part in parts:
        column = F.replace(column, F.lit(part))
    return column


def dashed(column: Column) -> Column:
    return F.replace(column, F.lit(" "), F.lit("-"))


def strip_brackets(column: Column) -> Column:
    return F.regexp_replace(column, r"[\{\}\[\]]", "")


def encode_url(column: Column) -> Column:
    """Percent-encode a URL path; letters, digits, ``_.-~`` and slashes stay as they are."""
    encoded = F.url_encode(column)
    # What form encoding writes differently from path encoding.
    for form, path in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(path))
    return encoded


def decimal_comma(column: Column) -> Column:
    return F.replace(column.cast("string"), F.lit("."), F.lit(","))


def joined(values: Column, separator: str) -> Column:
    """Array to text in sorted order, so the result does not depend on task timing."""
    return F.concat_ws(separator, F.sort_array(values))


def blank_fill(df: DataFrame) -> DataFrame:
    """Every column as trimmed text, blank where it was null."""
    return df.select(
        *[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in df.columns]
    )


def lower_columns(df: DataFrame, *drop: str) -> DataFrame:
    """Lower-case all column names, without the helper columns named in ``drop``."""
    dropped = {c.lower() for c in drop}
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns if c.lower() not in dropped])
