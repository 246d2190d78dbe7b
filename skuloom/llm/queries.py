"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuloom.llm.bpe import round_trip, token_counts
from skuloom.llm.common import digest
from skuloom.llm.exact_dedup import exact_groups
from skuloom.llm.fill_middle import fill_middle, restored
from skuloom.llm.order_minhash import near_duplicates
from skuloom.llm.packing import pack_documents
from skuloom.llm.quality_model import quality_scores
from skuloom.llm.quality_rules import quality_verdicts
from skuloom.llm.sharding import shard_documents
from skuloom.llm.spelling import spelling_variants
from skuloom.llm.suffix_dedup import suffix_dedup
from skuloom.llm.suffix_tree import language_scores
from skuloom.llm.toxicity import toxicity_scores

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


_EXACT_SQL = r"""
WITH digests AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM digests
WINDOW g AS (PARTITION BY text_sha256)
"""


@_query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir))


@_query("op2_exact_dedup", _EXACT_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def bpe_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), bpe_file())


@_query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), length=100)


@_query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir), limit=0.5)


@_query("op6_order_minhash")
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), least=0.8)


@_query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), bpe_file(), limit=512)


@_query("op8_quality_model")
def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), labels(spark, sf_dir), limit=0.3)


@_query("op9_jump_sharding")
def op9_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), shards=8)


@_query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), bpe_file(), size=2048)


_FILL_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), cut AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm'
              ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form,
         array_to_string(units[1:least(c1, c2)], '') AS head,
         array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS body,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS tail
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(body) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || body
                        ELSE '<S>' || tail || '<P>' || head || '<M>' || body END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@_query("op11_fill_middle", _FILL_SQL)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle(documents(spark, sf_dir))
    back = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(back).alias("restored_sha256"),
    )


@_query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


@_query("op13_suffix_tree_scores")
def op13_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(documents(spark, sf_dir))
