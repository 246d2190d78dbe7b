"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import joined, norm

_SALT, _WEIGHT, _COPIES = "_salt", "_peso", "_copias"
#: A key is heavy from a quarter of a task's fair share of rows on; it then gets sub-keys, as many as
#: put SPREAD of them into a fair share, so that their places even out.
_PART, SPREAD = 4, 16
#: Frequent-item summaries merge in two steps, the first one in this many groups.
_MERGES = 32


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salt_count(df: DataFrame) -> int:
    """Sub-keys per key where all keys get some: a quarter of the shuffle partitions, from 4 to 64."""
    return min(64, max(4, shuffle_tasks(df) // 4))


def is_sent_whole(df: DataFrame) -> bool:
    """Whether Spark estimates ``df`` below its own broadcast threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def heavy_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hashes of the keys that hold more than a part of a task's share, and their sub-keys.

    Each group of tasks makes a frequent-item summary of its rows; the summaries' counts are added up
    by key, so neither the rows nor many summaries meet. A group leaves out only keys below its own
    limit, so the sums fall short by at most that. At most ``_PART`` keys per shuffle partition can
    be heavy, and all sub-keys together are about ``SPREAD`` per partition, whatever the size of the
    data. Nothing runs before the join does.
    """
    tasks = shuffle_tasks(df)
    found = min(2 * _PART * tasks, 100_000)
    tracked = min(16 * found, 1_000_000)
    rows = df.select(F.xxhash64(*keys).alias(_WEIGHT), F.spark_partition_id().alias("_tarefa"))
    parts = rows.groupBy(F.pmod("_tarefa", F.lit(_MERGES)).alias("_grupo")).agg(
        F.count(F.lit(1)).alias("_linhas"),
        F.expr(f"approx_top_k({_WEIGHT}, {found}, {tracked})").alias("_resumo"),
    )
    whole = parts.agg(
        F.sum("_linhas").alias("_linhas"), F.flatten(F.collect_list("_resumo")).alias("_resumo")
    )
    sums = (
        whole.select("_linhas", F.inline("_resumo").alias(_WEIGHT, "_vezes"))
        .groupBy("_linhas", _WEIGHT)
        .agg(F.sum("_vezes").alias("_vezes"))
    )
    share = F.col("_vezes") / F.col("_linhas") * F.lit(tasks)
    return sums.where(share > 1 / _PART).select(_WEIGHT, F.ceil(share * SPREAD).cast("int").alias(_COPIES))


def _row_hash(df: DataFrame) -> Column:
    """Hash of a row's columns; Spark cannot hash maps, so these stay out."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashed)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with measured heavy keys of the left side; all other keys are joined as they are.

    A left row of a heavy key goes to one of the key's sub-keys, by a hash of the whole row moved
    on by the number of the task that made it: copies made by several tasks are spread, and a
    repeated task gives the same sub-key again. Right rows are repeated for the sub-keys of heavy keys
    only. The table of heavy keys is small by construction, see ``heavy_keys``, so it is broadcast.
    """
    heavy = F.broadcast(heavy_keys(left, keys))

    def marked(df: DataFrame) -> DataFrame:
        named = df.withColumn(_WEIGHT, F.xxhash64(*keys))
        return named.join(heavy, _WEIGHT, "left").withColumn(_COPIES, F.coalesce(_COPIES, F.lit(1)))

    number = F.pmod(_row_hash(left), F.lit(1 << 30)) + F.spark_partition_id()
    spread = left.withColumn("_numero", number)
    spread = marked(spread).withColumn(_SALT, F.pmod("_numero", _COPIES).cast("int"))
    repeated = marked(right).withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col(_COPIES) - 1)))
    own = [_WEIGHT, _COPIES]
    return spread.drop(*own, "_numero").join(repeated.drop(*own), [*keys, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    salts: int | None = None,
) -> DataFrame:
    """Join many rows to a lookup table whose keys may be hot on the left.

    A lookup that Spark itself estimates below its broadcast threshold is left to Spark, which
    needs no shuffle then. Beyond it the heavy keys of the left side are measured and split,
    see ``split_join``. With ``salts`` every key has that many sub-keys, without a measure.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join cannot be {how!r}")
    if salts is None:
        return left.join(right, keys, how) if is_sent_whole(right) else split_join(left, right, keys, how)
    number = F.pmod(_row_hash(left), F.lit(salts)) + F.spark_partition_id()
    spread = left.withColumn(_SALT, F.pmod(number, F.lit(salts)).cast("int"))
    repeated = right.withColumn(_SALT, F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return spread.join(repeated, [*keys, _SALT], how).drop(_SALT)


def join_normalised(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Equi-join of two text keys without regard to case and outer blanks; the left one may be hot."""
    keyed_left = left.withColumn("_chave", norm(F.col(left_key)))
    keyed_right = right.withColumn("_chave", norm(F.col(right_key)))
    if how in ("inner", "left", "left_semi", "left_anti"):
        return lookup_join(keyed_left, keyed_right, ["_chave"], how).drop("_chave")
    return keyed_left.join(keyed_right, "_chave", how).drop("_chave")


@dataclass(frozen=True)
class Link:
    """One many-to-many field: link rows (owner, item) and the item titles."""

    field: str
    links: DataFrame
    owner: str
    item: str
    items: DataFrame
    item_id: str
    title: str


def link_star(
    owners: DataFrame,
    owner_id: str,
    links: list[Link],
    separator: str = K.REFERENCE_SEPARATOR,
) -> DataFrame:
    """Titles of every linked item, joined per owner, one column per field.

    All link tables are stacked into one long table and all item tables into another, so the
    number of shuffles does not grow with the number of fields and no owner fans out. Fields are
    known by their places in ``links``: the tasks that drop repeated links hold fixed-width rows.
    """
    pairs = reduce(
        DataFrame.unionByName,
        [
            x.links.select(
                F.lit(i).alias("campo"),
                F.col(x.owner).alias("dono"),
                F.col(x.item).alias("item"),
            )
            for i, x in enumerate(links)
        ],
    ).distinct()
    titles = reduce(
        DataFrame.unionByName,
        [
            x.items.select(
                F.lit(i).alias("campo"),
                F.col(x.item_id).alias("item"),
                F.col(x.title).alias("titulo"),
            )
            for i, x in enumerate(links)
        ],
    )
    fields = [x.field for x in links]
    titled = lookup_join(pairs, titles, ["campo", "item"], "inner")
    wide = titled.groupBy("dono").agg(
        *[
            F.collect_set(F.when(F.col("campo") == i, F.col("titulo"))).alias(f)
            for i, f in enumerate(fields)
        ]
    )
    texts = wide.select("dono", *[joined(F.col(f), separator).alias(f) for f in fields])
    return owners.join(texts, owners[owner_id] == texts["dono"], "left").select(
        *[owners[c] for c in owners.columns], *[F.coalesce(f, F.lit("")).alias(f) for f in fields]
    )
