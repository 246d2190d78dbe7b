"""Several tables under one manifest: parts are written aside, then one small file names what is valid.

A reader follows the newest manifest, so it sees all changes of a commit or none, and a part that a
commit does not touch keeps its files. Manifests and data are only ever added; older versions stay
readable until the owner of the folder clears it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PART = "_parte"
_NO_VALUE = "nulo"


class CommitConflict(RuntimeError):
    """Another commit took the version that this one was made for."""


@dataclass(frozen=True)
class Table:
    """Schema, and the folder of every part; ``options`` say how rows are dealt to parts."""

    schema: StructType
    parts: dict[str, str]
    options: dict[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    version: int
    tables: dict[str, Table]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(root: str, version: int) -> str:
    return f"{root}/manifest-{version:012d}.json"


def current(spark: SparkSession, root: str) -> Snapshot:
    """The newest snapshot; version 0 without tables where there is none."""
    files = _files(spark, root)
    found = files.globStatus(_path(spark, f"{root}/manifest-*.json")) or []
    versions = [int(s.getPath().getName()[9:-5]) for s in found]
    if not versions:
        return Snapshot(0, {})
    stream = files.open(_path(spark, _manifest(root, max(versions))))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    tables = {
        name: Table(StructType.fromJson(t["schema"]), t["parts"], t["options"])
        for name, t in json.loads(text).items()
    }
    return Snapshot(max(versions), tables)


def commit(spark: SparkSession, root: str, base: Snapshot, tables: dict[str, Table]) -> Snapshot:
    """Make ``tables`` valid beside the other tables of ``base``, in one step.

    The manifest is written under another name and renamed to the next version; the rename fails
    if that version exists, so of two commits made from one base only the first goes through.
    """
    new = Snapshot(base.version + 1, base.tables | tables)
    text = json.dumps(
        {
            name: {"schema": t.schema.jsonValue(), "parts": t.parts, "options": t.options}
            for name, t in sorted(new.tables.items())
        }
    )
    files, aside = _files(spark, root), f"{root}/.manifest-{uuid.uuid4().hex}"
    stream = files.create(_path(spark, aside), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    target = _path(spark, _manifest(root, new.version))
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, aside), target, options)
    except Py4JJavaError as error:
        files.delete(_path(spark, aside), False)
        if files.exists(target):
            raise CommitConflict(f"version {new.version} of {root} exists") from error
        raise
    return new


def write_aside(df: DataFrame, root: str, table: str, part: Column) -> dict[str, str]:
    """Write the rows below a new folder, and return the folder of each part that has rows.

    Nobody reads these folders before a manifest names them. Rows of one part may be a large share
    of all, so the parts are evened out by size instead of being gathered in one task each.
    """
    spark = df.sparkSession
    folder = f"{root}/dados/{table}-{uuid.uuid4().hex}"
    named = df.withColumn(_PART, part.cast("string"))
    named.hint("rebalance", _PART).write.partitionBy(_PART).parquet(folder)
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    written = {}
    for status in _files(spark, folder).listStatus(_path(spark, folder)):
        name = status.getPath().getName()
        if name.startswith(f"{_PART}="):
            written[unescape(name[len(_PART) + 1 :])] = f"{folder}/{name}"
    return written


def merged_schema(old: StructType | None, new: StructType) -> StructType:
    """All columns of both; a column that both have keeps its type, or the commit is refused."""
    if old is None:
        return new
    known = {f.name: f for f in old.fields}
    for own in new.fields:
        kept = known.get(own.name)
        if kept is not None and kept.dataType != own.dataType:
            raise ValueError(f"column {own.name} is {kept.dataType}, not {own.dataType}")
    return StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


def read_parts(
    spark: SparkSession, snapshot: Snapshot, table: str, parts: list[str] | None = None
) -> DataFrame:
    """Rows of a table, or of some of its parts; files without a newer column give null there."""
    own = snapshot.tables[table]
    names = own.parts if parts is None else [p for p in parts if p in own.parts]
    if not names:
        return spark.createDataFrame([], own.schema)
    return spark.read.schema(own.schema).parquet(*[own.parts[p] for p in sorted(names)])


def read_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_parts(spark, current(spark, root), table)


def slice_part(value: Column) -> Column:
    """Part of a slice value; null has a part of its own, apart from every text."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(_NO_VALUE))


def publish_slices(
    spark: SparkSession,
    root: str,
    frames: dict[str, DataFrame],
    slice_column: str = "origem",
    slices: list[str | None] | None = None,
) -> list[str]:
    """Replace slices in several tables at once; returns the tables that were written.

    The slices found in a frame replace those of its table. ``slices`` names what was loaded: one
    of them without rows loses its rows, in every table of the folder, so a source that has no
    column of some type any more leaves nothing behind. If any table fails, no table changes.
    """
    base = current(spark, root)
    loaded = {_NO_VALUE if s is None else f"={s}" for s in slices or ()}
    changed: dict[str, Table] = {}
    for name, df in frames.items():
        old = base.tables.get(name)
        schema = merged_schema(old.schema if old else None, df.schema)
        written = write_aside(df, root, name, slice_part(F.col(slice_column)))
        kept = {p: f for p, f in (old.parts if old else {}).items() if p not in loaded}
        changed[name] = Table(schema, kept | written)
    for name, old in base.tables.items():
        if name not in changed and loaded & set(old.parts):
            kept = {p: f for p, f in old.parts.items() if p not in loaded}
            changed[name] = Table(old.schema, kept, old.options)
    commit(spark, root, base, changed)
    return sorted(frames)
