"""Exact dedup, sharding, quality rules, suffix dedup and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuloom.llm import order_minhash
from skuloom.llm import quality_rules as rules
from skuloom.llm.exact_dedup import drop_copies, exact_groups
from skuloom.llm.order_minhash import (
    _by_rows,
    drop_near_duplicates,
    edit_distance,
    near_duplicates,
    similar,
    sketches,
)
from skuloom.llm.quality_rules import LineLimits, clean_documents, quality_verdicts
from skuloom.llm.sharding import MULTIPLIER, shard_documents
from skuloom.llm.suffix_dedup import remove_repeats, suffix_dedup

# extra columns bear the names of the operators' own columns
SCHEMA = "doc_id bigint, text string, source string, kept boolean, base bigint, shard string"


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame([(*r, None, 1, "x") for r in rows], SCHEMA)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


ODD = [(1, None, "a"), (2, "", "a"), (None, "lone text", None), (None, "lone text", None),
       (3, "a  b", "a"), (3, "a\tb", "a"), (3, "a\tb", "a"), (4, "é" * 3000, "b")]


def test_exact_groups(docs):
    rows = ODD + [(k, "copy", "h") for k in range(10, 40)]
    got = exact_groups(docs(rows), counters=2).collect()
    assert len(got) == len(rows)
    plain = Counter(re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows)
    for r in got:
        text = next(t for t in plain if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == plain[text]
    assert sum(r.kept for r in got) == len(plain)
    assert {r.keep_id for r in got if r.doc_id in range(10, 40)} == {10}
    left = drop_copies(docs(rows), counters=2)
    assert left.columns == docs(rows).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 3, 4, 10]
    assert left.count() == len(plain)
    assert exact_groups(docs([])).count() == 0 and drop_copies(docs([])).count() == 0


def jump(key: int, shards: int) -> int:
    at, there = -1, 0
    while there < shards:
        at = there
        key = (key * MULTIPLIER + 1) % 2**64
        there = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_sharding(docs):
    rows = ODD + [(k, f"text {k}", "s") for k in range(300)] + [(7, "same", "s")] * 50
    got = shard_documents(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        name = "null" if r.doc_id is None else f"k{r.doc_id}"
        key = int(hashlib.md5(name.encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard) == (jump(key, 8), jump(key, 9))
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert shard_documents(docs([])).count() == 0


def test_base_counts():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("ab \n#é", k=rng.randint(0, 80)))
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, again, inside = set(), 0, [False] * len(own)
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        count = Counter(tuple(own[k : k + 8]) for k in range(len(own) - 7))
        for k in range(len(own) - 7):
            if count[tuple(own[k : k + 8])] > 1:
                inside[k : k + 8] = [True] * 8
        expected = len(own), sum(map(len, own)), text.count("#"), again, sum(inside)
        assert rules.base_counts(text) == expected


@pytest.mark.parametrize("most", [200_000, 0])
def test_frequent_lines(docs, monkeypatch, most):
    """Both ways to bring the frequent lines to the documents give the same rows."""
    monkeypatch.setattr(rules, "BROADCAST_LINES", most)
    limits = LineLimits(share=0.5, least=3, words_left=5, part_left=0.3)
    body = [words(k, 30) for k in range(12)]
    rows = [(k, f"Call 12 NOW\n{body[k]}", "h") for k in range(10)]
    rows += [(10, body[10], "h"), (11, f"call 34  now\n{' '.join(['x%d' % i for i in range(4)])}", "h")]
    rows += [(12, "call 1 now\n" + words(50, 25), "other"), (13, None, None), *[(14, body[11], "h")] * 9]
    got = {r.doc_id: r for r in quality_verdicts(docs(rows), limits).collect()}
    assert [k for k in range(15) if got[k].kept] == [*range(11), 12, 14]
    assert got[0].n_words_left == 30 and got[12].n_words_left == 28 and got[10].n_words_left == 30
    cleaned = clean_documents(docs(rows), limits)
    assert cleaned.columns == docs(rows).columns
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[3] == body[3] and texts[12].startswith("call 1 now") and 11 not in texts
    assert clean_documents(docs([]), limits).count() == 0
    assert quality_verdicts(docs([]), limits).count() == 0


def brute_suffix(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = text.encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            piece = raw[at : at + length]
            if piece in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(piece)
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        out[i] = len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()
    return out


def test_suffix_dedup(docs):
    shared = words(1, 40)
    rows = [(k, words(100 + k, 30) + shared + words(200 + k, 20)) for k in range(12)]
    rows += [(20, "ab" * 400), (21, "a" * 99), (22, "a" * 350), (23, "é" * 300), (24, "x" + "é" * 200)]
    rows += [(30 + k, rows[0][1] + " end") for k in range(3)] + [(40, rows[5][1][50:220]), (41, "")]
    got = suffix_dedup(docs([(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_suffix(rows)
    odd = suffix_dedup(docs([(1, shared, "s"), (None, shared, "s"), (1, shared, "s"), (2, None, "s")]))
    assert sorted((r.n_bytes, r.n_removed) for r in odd.collect()) == [
        (0, 0), (239, 0), (239, 0), (239, 239)]
    left = remove_repeats(docs([(1, shared, "s"), (2, f"{shared} tail", "s")]))
    assert sorted(r.text for r in left.collect()) == sorted([shared, " tail"])
    assert suffix_dedup(docs([])).count() == 0


def test_suffix_dedup_of_long_and_periodic_texts(docs):
    """Texts over a stretch of 262,144 bytes, a repeat across its end, one byte and a word over and over."""
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefghijklmnop", k=270_000))
    texts = [long, "x" * 900, long[262_000:262_400] + "tail", "a\u00e9b" * 200, "", long[5_000:5_099]]
    table = docs([(k, t, "s") for k, t in enumerate(texts)])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup(table).collect()}
    assert got == brute_suffix(list(enumerate(texts)))
    left = {r.doc_id: r.text for r in remove_repeats(table).collect()}
    assert left[0] == long and left[2] == "tail" and left[1] == "x" and left[5] == texts[5]


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 25))]
        b = [x for x in a if rng.random() > 0.2]
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.randint(0, 3))
        exact = slow_distance(a, b)
        for most in (0, 2, 8, 40):
            assert edit_distance(np.array(a), np.array(b), most) == min(exact, most + 1)
            if a and b and abs(len(a) - len(b)) <= most:
                assert _by_rows(np.array(a), np.array(b), most) == min(exact, most + 1)


def test_near_duplicates(docs):
    rng = random.Random(5)
    rows = [(k, words(k, 60)) for k in range(12)]
    for k in range(12):
        for copy in range(4):
            own = rows[k][1].split()
            for _ in range(2):
                own[rng.randrange(60)] = f"new{rng.random()}"
            rows.append((100 + 10 * k + copy, " ".join(own)))
    passage = words(99, 30)
    rows += [(300 + k, words(400 + k, 60) + " " + passage) for k in range(10)]
    rows += [(500, None), (501, " \n"), (502, "two words"), (503, "two  words"), (None, "two words")]
    table = docs([(i, t, "s") for i, t in rows])
    got = {r.doc_id: r for r in near_duplicates(table).collect()}
    assert len(got) == len(rows)
    for k in range(12):
        assert {got[100 + 10 * k + c].class_id for c in range(4)} == {k} and got[k].class_size == 5
    assert all(got[300 + k].class_size == 1 and got[300 + k].n_links == 0 for k in range(10))
    assert got[500].class_size == 2 and got[502].class_size == 3 and got[None].class_id == 502
    kept = {i for i, r in got.items() if r.kept}
    assert kept == {*range(12), *range(300, 310), 500, 502}
    left = drop_near_duplicates(table)
    assert left.columns == table.columns and {r.doc_id for r in left.collect()} == kept
    assert left.count() == len(kept)
    assert near_duplicates(docs([])).count() == 0
    assert similar(["a"] * 10, ["a"] * 8) and not similar(["a"] * 10, ["a"] * 7)


def edited(base: list[str], share: float, rng: random.Random) -> str:
    own = list(base)
    for at in rng.sample(range(len(own)), round(share * len(own))):
        own[at] = f"new{rng.random()}"
    return " ".join(own)


def test_edited_copies_meet_across_the_minimum(docs):
    """Copies are no links of each other, only of the base, which is seldom a bucket's minimum."""
    rng = random.Random(11)
    base = words(77, 200).split()
    rows = [(k, edited(base, 0.12, rng), "s") for k in range(150)] + [(200, " ".join(base), "s")]
    near = near_duplicates(docs(rows)).collect()
    largest = max(r.class_size for r in near)
    assert largest >= 130 and sum(r.class_size == 1 for r in near) == len(rows) - largest


def test_groups_without_links_make_no_row_per_pair(docs, monkeypatch):
    """Shortened copies of one text allow many links by their words, but few hold; each is tested once."""
    rng = random.Random(21)
    base = words(78, 150).split()
    texts = [[w for w in base if rng.random() > 0.17] for _ in range(300)]
    rows, test = [], order_minhash._linked

    def counted(pairs, *rest):
        rows.append(pairs.count())
        return test(pairs, *rest)

    monkeypatch.setattr(order_minhash, "_linked", counted)
    got = near_duplicates(docs([(k, " ".join(t), "s") for k, t in enumerate(texts)])).collect()
    first = list(range(300))
    met = [set(sketches(t)) for t in texts]
    for a in range(300):
        for b in range(a):
            if first[a] != first[b] and not met[a].isdisjoint(met[b]) and similar(texts[a], texts[b]):
                first = [min(first[a], first[b]) if f in (first[a], first[b]) else f for f in first]
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(first))
    assert len(set(first)) > 100
    assert sum(rows) < sum(map(len, met))


@pytest.mark.parametrize("n", [6, 9, 14, 15, 20, 60, 100, 110, 200])
def test_search_reaches_the_link_limit(n):
    """Pairs at edit similarity 0.80 to 0.90 share a sketch."""
    rng = random.Random(n)
    for least in (0.8, 0.85, 0.9):
        met = [0, 0]
        for k in range(60):
            base = words(1000 * n + k, n).split()
            other = edited(base, int((1 - least) * n + 1e-9) / n, rng).split()
            shorter = base[: n - int((1 - least) * n + 1e-9)]
            met[0] += not set(sketches(base)).isdisjoint(sketches(other))
            met[1] += not set(sketches(base)).isdisjoint(sketches(shorter))
        assert min(met) >= (60 if n <= 14 else 59)


def test_short_near_duplicates(docs):
    rows = [(1, "a b c d e", "s"), (2, "a b x d e", "s"), (3, "a b c d", "s"), (4, "a b c", "s")]
    rows += [(5, "k l m n o p q r s t", "s"), (6, "k l m x o p y r s t", "s"), (7, "k l m n o p z y x t", "s")]
    got = {r.doc_id: r.class_id for r in near_duplicates(docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7}


@pytest.mark.parametrize("n, few, many", [(10, 3, 4), (50, 5, 6), (3000, 50, 51)])
def test_frequent_lines_of_any_host(docs, n, few, many):
    """Default limits on a small, a middle and a large host: the rarer line stays, the other goes."""
    rows = [(k, f"{'rare line' if k < few else k}\n{'shared line' if k < many else k}\n{words(k, 30)}", "h")
            for k in range(n)]
    rows += [(0, rows[0][1], "h")] * 60  # repeated rows are one document
    left = {r.doc_id: r.text.split("\n") for r in clean_documents(docs(rows)).collect()}
    assert sorted(left) == list(range(n))
    assert sum("rare line" in x for x in left.values()) == few
    assert not any("shared line" in x for x in left.values())


@pytest.fixture
def odd_columns(spark):
    """Documents with a map column and column names with a dot and a backtick."""
    schema = "doc_id bigint, text string, source string, n_chars bigint, m map<string,int>, `a.b` int, `c``d` int"
    return lambda rows: spark.createDataFrame([(i, t, s, len(t or ""), {"k": 1}, 5, 6) for i, t, s in rows], schema)


def test_stages_carry_maps_and_odd_names(odd_columns):
    rows = [(k, words(k % 3, 40), "h") for k in range(9)] + [(3, words(0, 40), "h"), (None, None, None), (50, words(50, 40) + " x", "g")]
    docs = odd_columns(rows)
    for stage, left in ((clean_documents, 11), (drop_copies, 5), (drop_near_duplicates, 5), (remove_repeats, 12)):
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == left
        assert all(r.m == {"k": 1} and r["a.b"] == 5 and r["c`d"] == 6 for r in got)


def test_copies_do_not_make_their_own_lines_frequent(docs):
    """A host of 34 documents, five of them one text: the lines stay, and one copy survives."""
    text = "\n".join(words(9000 + k, 10) for k in range(4))
    rows = [(k, "\n".join(words(10 * k + j, 10) for j in range(4)), "h") for k in range(29)]
    rows += [(29 + k, text.replace(" ", "  ") if k == 2 else text, "h") for k in range(5)]
    kept = clean_documents(docs(rows))
    assert kept.count() == 34
    assert sorted(r.doc_id for r in drop_copies(kept).collect()) == list(range(30))
    few = [(k, words(k % 5, 60), "h") for k in range(20)]
    assert quality_verdicts(docs(few)).where("kept").count() == 20
    shared = [(k, words(0, 10) + "\n" + words(k + 1, 30), "h") for k in range(34)]
    assert clean_documents(docs(shared)).where(f"contains(text, '{words(0, 10)}')").count() == 0


def test_copies_of_a_hot_text_stay_once(docs):
    rows = [(k, "hot text here", "h") for k in range(400, 0, -1)] + [(k, words(k, 30), "h") for k in range(401, 500)]
    rows += [(1, "hot  text here", "h"), (None, "hot text here", "h"), (700, words(450, 30), "g")]
    left = drop_copies(docs(rows), counters=3)
    assert sorted(r.doc_id for r in left.collect()) == [1, *range(401, 500)]


def test_millions_of_equal_rows_are_dealt_to_many_tasks(spark):
    rows = spark.range(5_000_000, numPartitions=8).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = shard_documents(rows)
        sizes = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        slots = placed.agg(F.min("slot"), F.max("slot"), F.approx_count_distinct("slot", 0.01)).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in sizes) == 5_000_000 and len(sizes) >= 8
    assert max(r.n for r in sizes) < 1_500_000
    assert slots[0] == 0 and slots[1] == 4_999_999 and abs(slots[2] / 5e6 - 1) < 0.05
