"""Array rules: positions outside an array read as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_DEPTH = 6


def level(path: Column, position: int) -> Column:
    return F.get(path, F.lit(position))


def deepest(path: Column, depth: int = PATH_DEPTH) -> Column:
    """Last filled position among the first ``depth`` of a path."""
    return F.coalesce(*[level(path, i) for i in reversed(range(depth))])


def json_path(text: Column) -> Column:
    """``["a","b"]`` as an array; null for text that is no list."""
    return F.from_json(text, "array<string>")
