"""BPE against the tokenizers library, packing against its rules, models on held-out rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skuloom.llm.bpe import prefix_token_counts, round_trip, token_counts, vocabulary
from skuloom.llm.packing import END, pack_documents, pack_patterns
from skuloom.llm.quality_model import fit_trees, quality_scores
from skuloom.llm.queries import ORACLES, QUERIES
from skuloom.llm.toxicity import Tagger, fit_from_labels, toxic_spans, toxicity_scores, window_slopes

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.01"
HARD = [
    "", "a" * 27, " " * 300 + "x", "a<|endoftext|>b <|endoftext|>", "it's we're 're they'll 'll''s",
    "\n\n\n  x\t\t y", "日本語テキスト🎉👨‍👩‍👧", "x" * 2000, "!!<|endoftext|>!", "don't  <|endoftext|>  ok",
    "\u0000\u0001\x85\x1c z", "½²³ ①Ⅷ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def docs(spark):
    schema = "doc_id bigint, text string, ids string, length string"
    return lambda rows: spark.createDataFrame([(*r, "x", "y") for r in rows], schema)


def texts():
    rng = random.Random(4)
    pieces = ["<|endoftext|>", "a", " ", "  ", "'re", "'l", "!", "\n", "é", "hello", "日"]
    return HARD + ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(300)]


def test_encode_and_decode(library):
    own = vocabulary(PATH)
    for text, ids in zip(texts(), own.encode(texts()), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_every_prefix(library):
    own = vocabulary(PATH)
    for text in texts()[:120]:
        if len(text) > 400:
            continue
        counts = own.prefix_counts(text)
        expected = [
            len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)
        ]
        assert counts.tolist() == expected
        for budget in (2, 5):
            assert own.longest_prefix(text, budget) == np.flatnonzero(counts <= budget)[-1]


def test_token_queries(docs, library):
    rows = [(k, t) for k, t in enumerate(HARD)] + [(None, "a b"), (None, "a b"), (50, None)]
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    got = token_counts(docs(rows), PATH, limit=20).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(ids[t]) for _, t in rows)
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    for r in round_trip(docs(rows), PATH).collect():
        text = dict(rows)[r.doc_id] or ""
        shown = ",".join(map(str, library.encode(text, add_special_tokens=False).ids))
        assert r.ids_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert prefix_token_counts(docs([(1, None), (2, "ab")]), PATH).count() == 2
    assert token_counts(docs([]), PATH).count() == round_trip(docs([]), PATH).count() == 0


def test_packing(docs, library):
    rows = [(k, "word and " * (k * k)) for k in range(30)] + [(None, None), (3, "copy")] * 5
    rows += [(90, "a<|endoftext|>b"), *[(k, "same length text") for k in range(100, 160)]]
    got = pack_documents(docs(rows), PATH, size=64).collect()
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(library.encode(t or "", add_special_tokens=False).ids + [END])
    sequences, covered = defaultdict(list), defaultdict(int)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
        assert any(
            len(x) == r.doc_tokens
            and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            for x in ids[r.doc_id]
        )
    assert covered == {i: sum(map(len, x)) for i, x in ids.items()}
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(own)]).tolist()]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 64
    assert sum(covered.values()) > 0.95 * 64 * len(sequences)
    assert pack_documents(docs([]), PATH).count() == 0


def test_patterns_place_every_length():
    counts = {1: 7, 5: 1000, 20: 3, 63: 2, 33: 10}
    placed = defaultdict(int)
    for pattern, times in pack_patterns(counts, 64):
        assert sum(pattern) <= 64
        for length in pattern:
            placed[length] += times
    assert placed == counts


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    model = Tagger(np.zeros(4), 0.0, rng.normal(size=(2, 2)), np.zeros(4))
    sizes = np.array([3, 1, 0, 5])
    emission = rng.normal(size=9)
    got, at = model.marginals(emission, sizes), 0
    for n in sizes:
        own, total, one = emission[at : at + n], 0.0, np.zeros(n)
        for code in range(2**n):
            tag = [code >> k & 1 for k in range(n)]
            score = sum(e for e, t in zip(own, tag, strict=True) if t)
            score += sum(model.step[a, b] for a, b in zip(tag, tag[1:], strict=False))
            total += np.exp(score)
            one += np.exp(score) * np.array(tag)
        if n:
            assert np.allclose(got[at : at + n], one / total)
        at += n


def labelled(spark, docs, texts, toxic):
    rows = docs(list(enumerate(texts)))
    labels = [(k, None, int(x)) for k, x in enumerate(toxic)]
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_tagger_finds_spans(spark, docs):
    rng = random.Random(1)
    plain = ["".join(rng.choices("abcdefg", k=5)) for _ in range(200)]
    rows = [rng.choices(plain, k=50) for _ in range(200)]
    toxic = np.arange(200) % 4 == 0
    for own, bad in zip(rows, toxic, strict=True):
        if bad:
            own[10], own[30] = "zzgrumble", "zzsnark"
    model = fit_from_labels(*labelled(spark, docs, [" ".join(r) for r in rows], toxic))
    long = "abcde " * 300_000 + "zzgrumble"
    found = toxic_spans(
        docs([(1, "abcde ZZgrumble gfedc"), (2, "abc " * 40), (3, None), (4, long)]), model
    )
    got = {r.doc_id: r for r in found.collect()}
    assert [(s.begin, s.end) for s in got[1].spans] == [(6, 15)]
    assert got[2].spans == got[3].spans == [] and got[2].score < 0.5 and 0 <= got[3].score <= 1
    assert [(s.begin, s.end) for s in got[4].spans] == [(len(long) - 9, len(long))]


def test_short_texts_train_the_tagger(spark, docs):
    rng = random.Random(2)
    plain = ["".join(rng.choices("abcdefg", k=5)) for _ in range(200)]
    texts = [" ".join(rng.choices(plain, k=6)) + " zzgrumble" * (k % 4 == 0) for k in range(200)]
    found = toxicity_scores(*labelled(spark, docs, texts, np.arange(200) % 4 == 0)).collect()
    assert all((r.predicted == 1) == (r.doc_id % 4 == 0) == (r.n_spans == 1) for r in found)


def test_slopes_of_padded_windows_against_differences():
    rng = np.random.default_rng(5)
    weight, step, bias = rng.normal(size=20), rng.normal(size=(2, 2)), 0.3
    names, sizes = rng.integers(0, 20, (6, 7, 3)), np.array([7, 1, 3, 7, 5, 2])
    tags = rng.integers(0, 2, (6, 7))
    value, miss, steps = window_slopes(weight, bias, step, names, tags, sizes)
    exact = 0.0
    for own, tag, n in zip(weight[names].sum(2) + bias, tags, sizes, strict=True):
        score = lambda t: sum(e for e, x in zip(own, t) if x) + sum(map(lambda a, b: step[a, b], t, t[1:]))  # noqa
        paths = [score([c >> k & 1 for k in range(n)]) for c in range(2**n)]
        exact += score(tag[:n].tolist()) - np.log(np.exp(paths).sum())
    assert np.isclose(value, exact)
    for a in range(2):
        for b in range(2):
            other = step.copy()
            other[a, b] += 1e-6
            moved = window_slopes(weight, bias, other, names, tags, sizes)[0]
            assert np.isclose((moved - value) / 1e-6, steps[a, b], atol=1e-4)
    slope = np.bincount(names.ravel(), np.repeat(miss, 3, axis=1).ravel(), 20)
    for k in range(20):
        other = weight.copy()
        other[k] += 1e-6
        moved = window_slopes(other, bias, step, names, tags, sizes)[0]
        assert np.isclose((moved - value) / 1e-6, slope[k], atol=1e-4)


def test_trees_against_node_by_node_walk_and_full_search():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 4))
    y = (x[:, 1] + 0.3 * rng.normal(size=300) > 0.2).astype(float)
    trees = fit_trees(x, y, rounds=6, depth=3)
    for row, got in zip(x, trees.score(x), strict=True):
        total = trees.start
        for feature, limit, leaf in zip(trees.feature, trees.limit, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += leaf[node - len(feature)]
        assert np.isclose(got, 1 / (1 + np.exp(-total)))
    one = fit_trees(x, y, rounds=1, depth=1, bins=16)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))
    cuts = np.quantile(x, np.linspace(0, 1, 17)[1:-1], axis=0)
    gains = {}
    for f in range(4):
        for cut in cuts[:, f]:
            parts = [x[:, f] <= cut, x[:, f] > cut]
            gains[f, cut] = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in parts)
    assert np.isclose(gains[one.feature[0, 0], one.limit[0, 0]], max(gains.values()))


def test_trees_learn_and_take_one_class():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = fit_trees(x[:600], y[:600])
    assert ((trees.score(x[600:]) > 0.5) == y[600:]).mean() > 0.9
    assert np.ptp(fit_trees(x, np.ones(800)).score(x)) == 0
    assert np.allclose(fit_trees(x[:0], y[:0]).score(x[:3]), 0.5)


def test_scores_of_odd_rows(spark, docs):
    rows = docs([(1, "a b"), (1, "a b"), (None, None), (2, "")])
    labels = spark.createDataFrame([(1, None, 1), (None, 0, 0), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    for found in (quality_scores(rows, labels), toxicity_scores(rows, labels)):
        assert found.count() == 4
        assert all(0 <= r.score <= 1 for r in found.collect())
    assert quality_scores(docs([]), labels).count() == toxicity_scores(docs([]), labels).count() == 0


@pytest.mark.parametrize("name, column", [("op8_quality_model", "quality"), ("op5_toxicity", "toxic")])
def test_held_out_rows(spark, name, column):
    """Models rank the held-out rows of the small tables far better than chance."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").withColumnRenamed("doc_id", "i")
    scored = QUERIES[name](spark, SF_DIR).where("held_out")
    rows = scored.join(labels, scored.doc_id == labels.i).select("score", column).toPandas()
    good, bad = (rows.score[rows[column] == k].to_numpy() for k in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.75


def test_oracles_hold(spark):
    import compare

    con = compare.connect("/root/testdata/sf0.001")
    for name, sql in ORACLES.items():
        assert compare.differences(QUERIES[name](spark, "/root/testdata/sf0.001"), con, sql) is None


def test_packing_of_long_blank_runs(docs, library):
    rows = [(1, "a" + " " * 2_500_000 + "b<|endoftext|>"), (2, "a" + "\n" * 1_200_000), (3, "c")]
    got = pack_documents(docs(rows), PATH).collect()
    for i, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, END]
        own = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
        assert sum(n for _, n, _ in own) == len(ids)
        assert all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for s, n, c in own)
