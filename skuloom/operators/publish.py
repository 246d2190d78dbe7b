"""Published tables: renamed, typed, with urls and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import dashed, fold_accents, is_blank, without
from skuloom.operators.ids import surrogate_id
from skuloom.operators.joins import lookup_join


def rename_by_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns through a case-insensitive map; unmapped columns keep their name."""
    lowered = {k.lower(): v.lower() for k, v in names.items()}
    return df.select(*[F.col(f"`{c}`").alias(lowered.get(c.lower(), c)) for c in df.columns])


Spec = list[tuple[str | None, str, str, str | None]]


def _by_output(spec: Spec) -> dict[str, list[tuple[str | None, str, str | None]]]:
    outputs: dict[str, list[tuple[str | None, str, str | None]]] = {}
    for source, output, type_name, comment in spec:
        outputs.setdefault(output, []).append((source, type_name, comment))
    return outputs


def _described(column: Column, name: str, comment: str | None) -> Column:
    return column.alias(name, metadata={"comment": comment} if comment else {})


def typed_publish(df: DataFrame, spec: Spec, distinct: bool = True) -> DataFrame:
    """Rename, cast and describe columns as the control tables say.

    Rows are made distinct unless the caller knows that they are; that saves a shuffle of the
    widest table.

    Several inputs of one output fill each other in input-id order, text that does not cast
    becomes null, outputs without input are null, and columns outside the spec stay at the end.
    """
    available = {c.lower(): c for c in df.columns}
    columns, used = [], set()
    for output, entries in _by_output(spec).items():
        _, type_name, comment = entries[0]
        inputs = sorted({s for s, _, _ in entries if s in available})
        if not inputs and output in available:
            inputs = [output]
        used.update(inputs)
        values = [F.col(f"`{available[i]}`").try_cast(type_name) for i in inputs]
        value = F.coalesce(*values) if values else F.lit(None).cast(type_name)
        columns.append(_described(value, output, comment))
    outputs = {o.lower() for _, o, _, _ in spec}
    rest = [F.col(f"`{c}`") for k, c in available.items() if k not in used and k not in outputs]
    typed = df.select(*columns, *rest)
    return typed.distinct() if distinct else typed


def empty_table(spark: SparkSession, spec: Spec) -> DataFrame:
    """No rows, but the typed and described columns of the spec."""
    columns = [
        _described(F.lit(None).cast(entries[0][1]), output, entries[0][2])
        for output, entries in _by_output(spec).items()
    ]
    return spark.range(0).select(*columns)


def institutional_urls(
    products: DataFrame,
    links: DataFrame,
    hierarchy: DataFrame,
    history: DataFrame,
    base_url: str,
) -> DataFrame:
    """Catalogue url of every product placed on the site.

    Each level adds its own slug; a blank level adds the node description if the level above is
    filled and nothing otherwise. The end of the url is the historical one or name and sku.
    """
    own = [F.col(f"nivel{i}") for i in range(1, 5)]
    slugs = []
    for i, name in enumerate(own):
        slug = F.when(~is_blank(name), F.concat(dashed(name), F.lit("/")))
        if i > 0:
            slug = slug.when(F.trim(own[i - 1]) == "", F.lit(""))
        slugs.append(F.trim(slug.otherwise(F.concat(dashed(F.col("descricao")), F.lit("/")))))
    name_slug = without(dashed(without(F.trim("nome_produto"), '"', "/")), ".")
    suffix = F.coalesce("sufixo_hist", F.concat(name_slug, without(F.col("sku"), ".")))
    url = without(fold_accents(F.concat(F.lit(base_url), *slugs, suffix)), '"')

    extras = ["palavra_chave", "produto_relacionado", "assinatura_arquiteto"]
    past = history.select("sku", F.col("url").alias("sufixo_hist"), *extras)
    # Both joins by sku come first and share one partitioning; the nodes follow as a lookup.
    placed = (
        products.select("sku", "nome_produto")
        .join(links.select("sku", "hierarquia"), "sku")
        .join(past, "sku", "left")
    )
    nodes = hierarchy.select("hierarquia", "descricao", *[f"nivel{i}" for i in range(1, 5)])
    return (
        lookup_join(placed, nodes, ["hierarquia"], "inner")
        .select("sku", url.alias("url_catalogo_institucional"), *extras)
        .distinct()
    )


def publish_projection(
    df: DataFrame,
    columns: list[str],
    load_time: Column,
    initcap: dict[str, str] | None = None,
    aliases: dict[str, str] | None = None,
    key: str = "sku",
) -> DataFrame:
    """Fixed column list for a publish target, with audit columns and a hash id.

    ``initcap`` and ``aliases`` map an output name to the column it capitalises or repeats.
    """
    picked = [F.col(c) for c in columns]
    picked += [F.initcap(source).alias(name) for name, source in (initcap or {}).items()]
    picked += [F.col(source).alias(name) for name, source in (aliases or {}).items()]
    return (
        df.select(*picked)
        .distinct()
        .withColumns(
            {
                "created_at": load_time,
                "updated_at": load_time,
                **{c: F.lit("") for c in K.BLANK_AUDIT_COLUMNS},
                "id": F.xxhash64(key),
            }
        )
    )


def publish_stage(
    df: DataFrame, columns: list[str], order: list[str], blank: tuple[str, ...] = K.STAGE_AUDIT_COLUMNS
) -> DataFrame:
    """Distinct rows of a table as its target receives them: blank audit columns and a dense id.

    Ids run from 1 in the given order; ties are settled by the other columns.
    """
    rows = df.select(*columns).distinct()
    numbered = surrogate_id(rows, order)
    return numbered.select(*columns, *[F.lit("").alias(c) for c in blank], "id")
