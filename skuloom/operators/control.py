"""What the control tables decide: which attributes come in, their types, where they go out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom import constants as K
from skuloom.functions.text import flag, norm
from skuloom.functions.types import catalogue_type
from skuloom.operators.joins import lookup_join, salt_count
from skuloom.session import small_rows

MAX_SPEC_ROWS = 10_000


def active_ids(input_filter: DataFrame) -> DataFrame:
    """Normalised ids of the attributes that may enter, one row each."""
    return (
        input_filter.where(flag(F.col("ativo")))
        .select(norm(F.col("id_atributo_entrada")).alias("id_ativo"))
        .distinct()
    )


def keep_active(df: DataFrame, id_column: str, input_filter: DataFrame) -> DataFrame:
    """Rows whose attribute id is active in the input filter.

    The ids are control data, so they are always repeated per salt: adaptive execution leaves a
    hot id whole where a later grouping contains the id.
    """
    keyed = df.withColumn("id_ativo", F.lower(F.col(id_column)))
    active = active_ids(input_filter)
    return lookup_join(keyed, active, ["id_ativo"], "left_semi", salt_count(df)).drop("id_ativo")


def output_spec(
    input_filter: DataFrame,
    catalogue: DataFrame,
    output_filter: DataFrame,
    destination: str,
    require_active_input: bool = True,
) -> DataFrame:
    """Input id, output name, type and comment of every column one destination receives.

    With ``require_active_input`` off, outputs without catalogue or input rows are kept too.
    """
    key = norm(F.col("id_atributo_catalogo")).alias("chave")
    outputs = output_filter.where(
        (norm(F.col("sistema_destino")) == destination.lower()) & flag(F.col("ativo"))
    ).select(
        key, F.coalesce("id_atributo_saida", "id_atributo_catalogo").alias("atributo_saida")
    )
    types = catalogue.select(
        key,
        catalogue_type(F.col("tipo_dado_atributo"), F.col("casa_decimal")).alias("tipo"),
        "descricao",
    )
    inputs = input_filter
    if require_active_input:
        inputs = inputs.where(flag(F.col("ativo")))
    inputs = inputs.select(key, norm(F.col("id_atributo_entrada")).alias("id_atributo_entrada"))
    how = "inner" if require_active_input else "left"
    return (
        outputs.join(types, "chave", how)
        .join(inputs, "chave", how)
        .select(
            "id_atributo_entrada",
            F.lower("atributo_saida").alias("atributo_saida"),
            F.coalesce("tipo", F.lit("string")).alias("tipo"),
            "descricao",
        )
        .distinct()
    )


def spec_rows(spec: DataFrame) -> list[tuple[str | None, str, str, str | None]]:
    """The spec on the driver, where it decides a schema; refused beyond ``MAX_SPEC_ROWS``."""
    rows = spec.orderBy("atributo_saida", "id_atributo_entrada").limit(MAX_SPEC_ROWS + 1).collect()
    if len(rows) > MAX_SPEC_ROWS:
        raise ValueError(f"a published table cannot have more than {MAX_SPEC_ROWS} columns")
    return [(r.id_atributo_entrada, r.atributo_saida, r.tipo, r.descricao) for r in rows]


def rename_map(input_filter: DataFrame) -> dict[str, str]:
    """Catalogue name of every input id, for renaming columns; refused beyond ``MAX_SPEC_ROWS``."""
    pairs = (
        input_filter.where(F.trim("id_atributo_catalogo") != "")
        .groupBy(norm(F.col("id_atributo_entrada")).alias("entrada"))
        .agg(F.max(norm(F.col("id_atributo_catalogo"))).alias("catalogo"))
        .limit(MAX_SPEC_ROWS + 1)
        .collect()
    )
    if len(pairs) > MAX_SPEC_ROWS:
        raise ValueError(f"more than {MAX_SPEC_ROWS} columns to rename")
    return {r.entrada: r.catalogo for r in pairs}


def attribute_classes(input_filter: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Long list (input id, catalogue id, class) of the attribute classes used by the checks."""
    table, kind = F.col("nome_tabela"), F.col("tipo_dado_atributo")
    record = ~table.isin(*K.DOCUMENT_TABLES)
    classes = F.array(
        F.when(table.isin(*K.DOCUMENT_TABLES), F.lit("documento")),
        F.when(table.isin(*K.IMAGE_TABLES), F.lit("imagem")),
        F.when(record, F.lit("golden_record")),
        F.when(record & (kind == "LOV"), F.lit("lov")),
        F.when(record & kind.isin("string", "text"), F.lit("text")),
        F.when(record & (kind == "number"), F.lit("number")),
    )
    entries = catalogue.select("id_atributo_catalogo", F.array_compact(classes).alias("classes"))
    inputs = input_filter.select(
        norm(F.col("id_atributo_entrada")).alias("id_atributo_entrada"), "id_atributo_catalogo"
    )
    return (
        lookup_join(inputs, entries, ["id_atributo_catalogo"], "inner", salt_count(inputs))
        .select("id_atributo_entrada", "id_atributo_catalogo", F.explode("classes").alias("classe"))
        .distinct()
    )


def class_ids(input_filter: DataFrame, catalogue: DataFrame, name: str) -> DataFrame:
    """Distinct input ids of one attribute class."""
    return (
        attribute_classes(input_filter, catalogue)
        .where(F.col("classe") == name)
        .select("id_atributo_entrada")
        .distinct()
    )


def schema_rows(df: DataFrame, system: str, table: str, load_time: F.Column) -> DataFrame:
    """One inactive input-filter row per column of ``df``."""
    rows = [(system, table, c.strip().lower()) for c in df.columns]
    described = small_rows(
        df.sparkSession, rows, "sistema_origem string, tabela_origem string, id_atributo_entrada string"
    )
    return described.select(
        "*",
        F.lit("").alias("id_atributo_catalogo"),
        F.lit("false").alias("ativo"),
        load_time.alias("data_criacao"),
    )
