"""Helpers of the operators: scratch tables, null-safe columns, joins with hot keys, components."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skuloom.session import new_dir

ROOT = str(Path(__file__).resolve().parents[2])
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Characters that part words; everything else belongs to a word.
BLANKS = r"[\x20\x09-\x0D]+"
#: Bits of the filter that spares rows a shuffle: 2 MB, as at most 270,601 words of 62 bits.
FILTER_BITS, _WORD = 1 << 24, 62
#: Equal rows that are laid out in one go.
RUN = 10_000


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package when it was not shipped with ``--py-files``."""
    paths = spark.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(":"):
        paths["PYTHONPATH"] = ":".join(filter(None, [ROOT, paths.get("PYTHONPATH")]))


@contextmanager
def _tidy_shuffles(spark: SparkSession):
    """Shuffle files go when the enclosed write has ended, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    The files outlive lost executors and cut the lineage; what follows may read them several
    times. Row order inside a file never matters to a reader.
    """
    spark = df.sparkSession
    path = new_dir(spark, label)
    with _tidy_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the scratch files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(docs: DataFrame) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case rules."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, also names with dots or backticks."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def by_position(df: DataFrame) -> DataFrame:
    """``df`` with plain column names; ``mapInArrow`` cannot take names with dots or backticks."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def row_hash(df: DataFrame) -> Column:
    """Hash of a row; Spark cannot hash maps, so columns that hold one stay out."""
    fields = zip(quoted(df), df.schema.fields, strict=True)
    return F.xxhash64(*[c for c, f in fields if "map<" not in f.dataType.simpleString()])


def may_hold(df: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: false only for keys that are not in ``keys``.

    A Bloom filter of one hash function over ``FILTER_BITS`` bits. Its words, at most one for each
    62 bits, are broadcast as a table, so its size does not depend on the data; with many more keys
    than bits it says yes to more rows, which costs a shuffle of them but no result.
    """
    (own,) = keys.columns
    place = F.pmod(F.xxhash64(F.col(own)), F.lit(FILTER_BITS))
    bit = F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(`{own}`), {FILTER_BITS}) % {_WORD} AS INT))")
    words = keys.select(F.floor(place / _WORD).alias("_word"), bit.alias("_bit"))
    words = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    spot, at, bits = fresh(df, "_spot"), fresh(df, "_at"), fresh(df, "_bits")
    words = F.broadcast(words.toDF(at, bits))
    marked = df.withColumn(spot, F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)))
    marked = marked.withColumn(at, F.floor(F.col(spot) / _WORD)).join(words, at, "left")
    hit = F.expr(f"shiftright(coalesce(`{bits}`, 0L), CAST(`{spot}` % {_WORD} AS INT)) & 1L") == 1
    return marked.withColumn(name, hit).drop(spot, at, bits)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, salts: int = 16
) -> DataFrame:
    """Join many rows to a table that has each key once, where keys may be hot on the left.

    Left rows spread over ``salts`` sub-keys by a hash of their columns and of the task that made
    them; the table is repeated once per sub-key. No partition depends on one key alone.
    """
    salt = fresh(left, "_salt")
    spread = left.withColumn(
        salt, F.pmod(F.xxhash64(row_hash(left), F.spark_partition_id()), F.lit(salts)).cast("int")
    )
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*keys, salt], how).drop(salt)


def in_runs(counted: DataFrame, copies: str, run: str) -> DataFrame:
    """Counted rows as runs of at most ``RUN`` copies, numbered by ``run``.

    A row that stands for millions of equal ones thus becomes several, which later steps can deal
    to several tasks.
    """
    last = F.floor((F.col(copies) - 1) / RUN)
    runs = counted.withColumn(run, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    left = F.col(copies) - F.col(run) * RUN
    return runs.withColumn(copies, F.least(left, F.lit(RUN).cast("long")))


def running_starts(
    df: DataFrame, group: list[str], block: str, order: list[str], rows: str, name: str = "first"
) -> DataFrame:
    """Column ``name``: rows of the same group before this one, in the order of block, then ``order``.

    ``rows`` says how many rows each line stands for. A group may be any share of the data: it is
    numbered block by block, and only one count per group and block is summed up across blocks.
    """
    per_block = df.groupBy(*group, block).agg(F.sum(rows).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *group, block, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(*group, block)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = df.withColumn("_within", F.coalesce(F.sum(rows).over(inside), F.lit(0)))
    return (
        numbered.join(offsets, [*group, block])
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_within", "_offset")
    )
