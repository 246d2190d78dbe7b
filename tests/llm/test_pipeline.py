"""The stages on the small tables and on a few hand-made documents."""

from __future__ import annotations

import random

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        assert 0 < out.count() <= docs.count()
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_planted_cases(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = [" ".join(word() for _ in range(80)) for _ in range(20)]
    passage = " ".join(word() for _ in range(60))
    near = texts[2].split()
    near[40] = "changed"
    rows = list(enumerate(texts)) + [(50, texts[1]), (51, " ".join(near)), (52, "too short")]
    rows += [(60 + k, f"{' '.join(word() for _ in range(80))} {passage}") for k in range(3)]
    table = [(i, t, "en", "s", len(t)) for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(table, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    got = {r.doc_id: r for r in docs.collect()}
    assert sorted(got) == [*range(20), 60, 61, 62]
    assert passage in got[60].text and passage not in got[61].text and passage not in got[62].text
    assert all(got[k].text == texts[k] for k in range(20))
    assert all(r.n_chars == len(r.text) for r in got.values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(got)
