"""Category trees: dimension, product links and site paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.arrays import deepest, json_path, level
from skuloom.functions.text import norm
from skuloom.operators.joins import lookup_join

LEVELS = 5
#: Combinations of one product that a task expands at a time.
BLOCK = 10_000


def hierarchy_dim(nodes: DataFrame, load_time: Column) -> DataFrame:
    """One row per node with its ancestors as levels; missing levels below the root are blank."""
    path = F.col("ancestors")
    levels = [level(path, 0).alias("nivel0")]
    levels += [F.coalesce(level(path, i), F.lit("")).alias(f"nivel{i}") for i in range(1, LEVELS)]
    rows = nodes.select(
        F.col("_id").alias("hierarquia"),
        F.col("name").alias("descricao"),
        F.col("brand").alias("marca"),
        *levels,
    ).distinct()
    return rows.withColumn("data_ingestao", load_time)


def deepest_nodes(products: DataFrame, path: str, output: str) -> DataFrame:
    """Distinct (sku, brand, deepest node of the path)."""
    return products.select("sku", "brand", deepest(F.expr(path)).alias(output)).distinct()


def hierarchy_link(
    primary: DataFrame, marketing: DataFrame, website: DataFrame, origin: str, load_time: Column
) -> DataFrame:
    """Primary, marketing and website node of every sku found in any of the three sources.

    The sources are stacked and gathered by sku in one aggregation that drops copies before the
    shuffle; several distinct nodes of one kind give several rows, as the joins would.
    """
    sources = {
        "hierarquia_primaria": (primary, F.col("hierarchies.primary")),
        "hierarquia_marketing": (marketing, F.get("hierarchies.secondaries.marketing", F.lit(0))),
        "hierarquia_website": (website, F.get("hierarchies.secondaries.website", F.lit(0))),
    }
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(
                "sku", F.lit(kind).alias("tipo"), F.struct("brand", deepest(path).alias("no")).alias("ligacao")
            )
            for kind, (df, path) in sources.items()
        ],
    )
    gathered = stacked.groupBy("sku").agg(
        *[F.collect_set(F.when(F.col("tipo") == kind, F.col("ligacao"))).alias(kind) for kind in sources]
    )
    return (
        combinations(gathered, list(sources))
        .select(
            "sku",
            F.coalesce(*[F.col(f"{kind}.brand") for kind in sources]).alias("marca"),
            *[F.col(f"{kind}.no").alias(kind) for kind in sources],
        )
        .distinct()
        .withColumns({"origem": F.lit(origin), "data_ingestao": load_time})
    )


def combinations(df: DataFrame, arrays: list[str], block: int = BLOCK) -> DataFrame:
    """Every combination of one element of each array, as ``explode_outer`` of all of them gives.

    Combinations are numbered, and the numbers cut into blocks: a row with many of them is dealt as
    blocks to many tasks, each of which expands at most ``block`` rows from it. Empty and null
    arrays give one null.
    """
    rest = [c for c in df.columns if c not in arrays]
    sizes = [F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(1)).cast("long") for a in arrays]
    total = reduce(lambda x, y: x * y, sizes)
    counted = df.withColumn("_total", total)
    few = counted.where(F.col("_total") <= block).withColumn("_bloco", F.lit(0).cast("long"))
    many = counted.where(F.col("_total") > block).withColumn(
        "_bloco", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_total") - 1) / block)))
    )
    dealt = few.unionByName(many.repartition(F.col("_bloco"), F.xxhash64(*rest)))
    first = F.col("_bloco") * block
    last = F.least(first + block, F.col("_total")) - 1
    numbered = dealt.withColumn("_numero", F.explode(F.sequence(first, last)))
    picked, unit = [], F.lit(1).cast("long")
    for name, size in zip(arrays, sizes, strict=True):
        place = F.floor(F.col("_numero") / unit) % size
        picked.append(F.get(name, place.cast("int")).alias(name))
        unit = unit * size
    return numbered.select(*rest, *picked)


def site_paths(products: DataFrame, root: str = K.SITE_ROOT_NODE) -> DataFrame:
    """Distinct (sku, path position, deepest node) of the site paths.

    The first site list holds either several paths, written as JSON lists, or the nodes of one
    path. Several paths: those below the ``root`` and those of one level are dropped. One path:
    position 0, no filter. Both shapes are handled in one pass without a join.
    """
    items = F.get("hierarchies.secondaries.site", F.lit(0))
    listed = products.select("sku", items.alias("itens")).where(F.size("itens") > 0)
    parsed = listed.withColumn("caminhos", F.transform("itens", json_path))
    several = F.exists("caminhos", lambda p: p.isNotNull())
    many = F.filter(
        F.transform("caminhos", lambda p, i: F.struct(i.alias("idx"), p.alias("caminho"))),
        lambda e: (F.size(e["caminho"]) > 1) & (F.trim(F.get(e["caminho"], F.lit(0))) != root),
    )
    one = F.array(F.struct(F.lit(0).alias("idx"), F.col("itens").alias("caminho")))
    return (
        parsed.select("sku", F.inline(F.when(several, many).otherwise(one)))
        .select("sku", "idx", deepest(F.col("caminho")).alias("hierarquia"))
        .distinct()
    )


def on_site(products: DataFrame, links: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Products whose site flag is on and whose site node has a first and second level.

    ``products`` is unique per sku, as the pivot makes it; wide rows are not compared again.
    """
    nodes = hierarchy.where(
        F.col("nivel1").isNotNull() & F.col("nivel2").isNotNull()
    ).select("hierarquia")
    placed = lookup_join(links.select("sku", "hierarquia"), nodes, ["hierarquia"], "left_semi")
    shown = products.where(norm(F.col(K.SITE_FLAG_ATTRIBUTE)) == K.SITE_FLAG_VALUE)
    return shown.join(placed.select("sku").distinct(), "sku", "left_semi")
