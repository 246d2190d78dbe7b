"""Fill-in-middle, spelling variants and language scores against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from skuloom.llm import spelling, suffix_tree
from skuloom.llm.fill_middle import BLOCK, BlockTree, FillPlan, fill_middle, restored
from skuloom.llm.queries import ORACLES, QUERIES
from skuloom.llm.spelling import _compare_sorted, _first_keys, near_words, spelling_variants
from skuloom.llm.suffix_tree import BEGIN, END, TreeLimits, language_scores, text_pieces, tokenise

# extra columns clash with the operators' own, hold a map, and have a dot in the name
SCHEMA = "doc_id bigint, text string, n map<string,int>, word string, `a.b` int, _row bigint"


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame([(*r, {"a": 1}, "x", 1, 2) for r in rows], SCHEMA)


def lines(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "\n".join("".join(rng.choices("ab é€\U0001f600", k=rng.randrange(60))) for _ in range(n))


TEXTS = [None, "", "\n", "one", "one\n", "\n\na", "x <P> y\nz", "a<\nS>b", lines(1, 400),
         lines(2, 90) + "\n", "é" * 5000, "<\n<\n<\n", lines(3, 3)]


def middle(text: str, doc_id, unit: str = r"[^\n]*\n|[^\n]+", rate: int = 100):
    units = re.findall(unit, text, re.S)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < 50 else "psm", len(p), len(m), out


@pytest.mark.parametrize("unit, pattern", [("line", r"[^\n]*\n|[^\n]+"), ("character", ".")])
def test_fill_middle(docs, unit, pattern):
    plan = FillPlan(unit=unit, fim_rate=80)
    rows = [(k, t) for k, t in enumerate(TEXTS * 6)] + [(None, "a\nb"), (3, "one"), (3, "one")]
    cut = fill_middle(docs(rows), plan)
    got = cut.withColumn("back", restored(F.col("output"), F.col("form"), plan)).collect()
    want = Counter((i, *middle(t or "", i, pattern, 80), t or "") for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert fill_middle(docs([]), plan).count() == 0


def test_block_tree_finds_every_boundary():
    text = lines(5, 300).encode()
    assert len(text) > 3 * BLOCK
    tree = BlockTree(text)
    units = re.findall(rb"[^\n]*\n|[^\n]+", text)
    at = 0
    for k in range(len(units) + 1):
        assert tree.boundary(k, "line") == (at, len(text[:at].decode()))
        at += len(units[k]) if k < len(units) else 0
    plain = text.decode()
    for k in range(0, len(plain) + 1, 37):
        assert tree.boundary(k, "character") == (len(plain[:k].encode()), k)


def test_markers_must_not_overlap():
    with pytest.raises(ValueError):
        FillPlan(prefix="<a>", suffix="a")
    with pytest.raises(ValueError):
        FillPlan(middle="aba")
    with pytest.raises(ValueError):
        FillPlan(unit="word")


def test_fill_middle_sql(spark):
    folder = "/root/testdata/sf0.001"
    frame = QUERIES["op11_fill_middle"](spark, folder)
    assert differences(frame, connect(folder), ORACLES["op11_fill_middle"]) is None


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def variants(rows: list[tuple]) -> set[tuple]:
    counts: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}
    form, out = {}, []
    partners = {w: [v for v in n if near(v, w)] for w in n}
    for w in n:
        best = min(partners[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(partners[w]), form.get(w), n.get(form.get(w)), root))
    return set(out)


def test_spelling_variants(docs):
    rng = random.Random(4)
    words = ["".join(rng.choices("abé×", k=rng.randrange(7, 10))) for _ in range(150)]
    words += ["aaaaaaa", "aaaaaaaa", "Größere", "grösere", "aaabaaa", "ab" * 40, "ab" * 40 + "a"]
    rows = [(k, " ".join(rng.choices(words, k=60)).upper() if k % 9 == 0 else
             ", ".join(rng.choices(words[: 1 + k], k=80))) for k in range(120)]
    rows += [(None, "aaaaaaa aaaaaaa"), (3, None), (3, ""), (4, "aaaaaaa " * 5000), (4, "Ωaaaaaaaß€")]
    rows += [(5, "bbbbbbb " * 30), (6, "bbbbbbbb " * 900), (7, "bbbbbbbbb " * 30000)]
    got = {tuple(r) for r in spelling_variants(docs(rows)).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    want = variants(rows)
    assert got == want
    assert any(r[3] for r in want) and any(r[3] and r[5] != r[3] for r in want)
    assert spelling_variants(docs([])).count() == 0
    assert spelling_variants(docs([(1, None), (2, "short")])).count() == 0


def rounds(words: list[str]) -> Counter:
    """Links of words as ``near_words`` finds them, in this process."""
    batch = pa.RecordBatch.from_pydict({"word": words, "n": pa.array([2] * len(words), pa.int64())})
    rows, links = list(_first_keys(iter([batch]), 7)), Counter()
    while rows:
        table = pa.Table.from_batches(rows).sort_by("key")
        out = pa.Table.from_batches(list(_compare_sorted(iter(table.to_batches(max_chunksize=7)))))
        kept = pa.compute.is_null(out["key"])
        for a, b in zip(out.filter(kept)["word"].to_pylist(), out.filter(kept)["other"].to_pylist(), strict=True):
            links[a, b] += 1
        rest = out.filter(pa.compute.invert(kept))
        rows = rest.to_batches() if rest.num_rows else []
    return links


@pytest.mark.parametrize("bucket", [4, 2048])
@pytest.mark.parametrize("length", [7, 13, 40])
def test_large_buckets_lose_and_double_no_pair(monkeypatch, bucket, length):
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    rng = random.Random(length)
    base = "".join(rng.choices("ab", k=length))
    words = {base}
    while len(words) < 150:
        w = list(rng.choice(sorted(words)))
        k = rng.randrange(len(w))
        w[k] = rng.choice(["", "a", "b", "ab", "ÿ"])
        if len("".join(w)) >= 7:
            words.add("".join(w))
    want = Counter((a, b) for a in words for b in words if near(a, b))
    assert rounds(sorted(words)) == want and want


def test_near_words_keeps_counts(spark):
    words = spark.createDataFrame([("abcdefg", 5), ("abcdefgh", 2), ("abcdefx", 3)], "word string, n bigint")
    got = {tuple(r) for r in near_words(words).collect()}
    assert got == {("abcdefg", "abcdefgh", 2), ("abcdefgh", "abcdefg", 5), ("abcdefg", "abcdefx", 3),
                   ("abcdefx", "abcdefg", 5), ("abcdefgh", "abcdefx", 3), ("abcdefx", "abcdefgh", 2)} - {
                   ("abcdefgh", "abcdefx", 3), ("abcdefx", "abcdefgh", 2)}


def plain_tokens(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


class PlainTree:
    """The tree by its definition, over dictionaries."""

    def __init__(self, texts: list[list[str]], limits: TreeLimits) -> None:
        self.count: Counter = Counter()
        for t in texts:
            row = (BEGIN, *t)
            for k in range(len(row)):
                for size in range(1, limits.depth + 2):
                    if k + size <= len(row):
                        self.count[row[k : k + size]] += 1
        self.single = Counter(w for t in texts for w in t)
        self.tokens, self.distinct = sum(self.single.values()), len(self.single)
        low = limits.support(self.tokens)
        self.off = limits.discount
        self.after: dict[tuple, dict] = defaultdict(dict)
        for s, n in self.count.items():
            if len(s) > 1 and n >= low:
                self.after[s[:-1]][s[-1]] = n
        self.kept: set[tuple] = set()
        for s in sorted(self.after, key=len, reverse=True):
            nats = mass = 0.0
            for w in self.after[s]:
                p, q = self.prob(s, w), self.prob(s[1:], w)
                nats, mass = nats + p * math.log(p / q), mass + p
            nats += max(0.0, 1 - mass) * math.log(self.rest(s))
            if nats >= limits.divergence and nats * self.count[s] >= limits.gain:
                self.kept |= {s[k:] for k in range(len(s))}

    def rest(self, s: tuple) -> float:
        found = self.after[s]
        return 1 - (sum(found.values()) - self.off * len(found)) / self.count[s]

    def prob(self, s: tuple, w: str) -> float:
        if not s:
            return (self.single[w] + 1) / (self.tokens + self.distinct + 1)
        found = self.after.get(s)
        if not found:
            return self.prob(s[1:], w)
        own = (found[w] - self.off) / self.count[s] if w in found else 0.0
        return own + self.rest(s) * self.prob(s[1:], w)

    def score(self, tokens: list[str], depth: int) -> float:
        row, total = (BEGIN, *tokens), 0.0
        for k in range(1, len(row)):
            s = row[max(0, k - depth) : k]
            while s and s not in self.kept:
                s = s[1:]
            total += math.log10(self.prob(s, row[k]))
        return total


def test_language_scores(docs):
    rng = random.Random(9)
    words = [f"w{k}é" for k in range(40)] + ["The", "the", "of"]
    rows = []
    for k in range(160):
        order = [rng.choice(words) for _ in range(rng.randrange(60))]
        order += rng.choice([["w2é", "the", "of", "w1é"], ["w3é", "the", "of", "w4é"]]) + [f"odd{k}"]
        rows.append((k, rng.choice([" ", "\n", "\t \x0b"]).join(order)))
    rows += [(None, "the of"), (7, None), (8, ""), (9, "   "), (11, "the of the of"), (11, "the of the of"),
             (12, "a" * 50_000 + " the of w1é " * 30)]
    limits = TreeLimits(depth=3, least=4, gain=2.0)
    got = language_scores(docs(rows), limits).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tree = PlainTree([plain_tokens(t) for i, t in rows if not held(i)], limits)
    assert any(len(s) == 3 for s in tree.kept) and len(tree.kept) > 5
    want = Counter()
    for i, t in rows:
        own = plain_tokens(t)
        base = sum(math.log10((tree.single[w] + 1) / (tree.tokens + tree.distinct + 1)) for w in own)
        known = sum(tree.single[w] > 0 for w in own)
        want[i, held(i), len(own), known, tree.tokens, round(base, 5), round(tree.score(own, 3), 5)] += 1
    assert Counter((*r[:5], round(r[5], 5), round(r[6], 5)) for r in got) == want
    for s in [(), ("the",), ("the", "of"), ("the", "of", "w1é"), ("nope",)]:
        total = sum(tree.prob(s, w) for w in tree.single) + tree.prob(s, "unknown")
        assert total == pytest.approx(1)


def plain_scores(rows: list[tuple], limits: TreeLimits) -> tuple[Counter, PlainTree]:
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tree, want = PlainTree([plain_tokens(t) for i, t in rows if not held(i)], limits), Counter()
    for i, t in rows:
        own = plain_tokens(t)
        base = sum(math.log10((tree.single[w] + 1) / (tree.tokens + tree.distinct + 1)) for w in own)
        known = sum(tree.single[w] > 0 for w in own)
        score = round(tree.score(own, limits.depth), 5)
        want[i, held(i), len(own), known, tree.tokens, round(base, 5), score] += 1
    return want, tree


@pytest.mark.parametrize("places", [40, 300, 1 << 20])
@pytest.mark.parametrize("limits", [TreeLimits(), TreeLimits(depth=2, least=2, gain=1.0), TreeLimits(gain=60.0)])
def test_strings_of_any_count_are_learnt(monkeypatch, docs, places, limits):
    """With few places in a task, most contexts are in the top of the tree."""
    monkeypatch.setattr(suffix_tree, "_PLACES", places)
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("the the of a x y".split() + [f"r{rng.randrange(300)}"])
                         for _ in range(rng.randrange(40)))) for k in range(120)]
    rows += [(k + 500, t) for k, t in rows[:30]] + [(None, "the of the of"), (7, None), (8, " ")]
    got = language_scores(docs(rows), limits).collect()
    want, tree = plain_scores(rows, limits)
    assert Counter((*r[:5], round(r[5], 5), round(r[6], 5)) for r in got) == want
    assert any(tree.count[s] <= 3 for s in tree.kept) == (limits.gain == 1) and tree.kept


def test_texts_seen_twice_score_higher_in_a_large_corpus(docs):
    """A string's share of the tokens decides nothing: 4 of 1.7 million are learnt as 4 of 2,000."""
    twice = [" ".join(f"q{k}v{j}" for j in range(50)) for k in range(4)]
    rows = [(3 * k, " ".join(f"w{(k * 7 + j * j) % 5000}" for j in range(1000))) for k in range(2000)]
    seen = [k for k in range(100_000, 101_000) if zlib.crc32(str(k).encode()) % 7 != 2]
    rows += [(seen[8 * k + j], t) for k, t in enumerate(twice) for j in range(4)]
    got = {r.doc_id: r for r in language_scores(docs(rows)).collect() if r.doc_id >= 100_000}
    for r in got.values():
        assert r.n_tokens == 51 and r.score > r.base_score + 150


def test_language_scores_without_rows_or_training(docs):
    assert language_scores(docs([])).count() == 0
    alone = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = language_scores(docs([(alone, "some words")])).collect()
    assert row.held_out and row.n_tokens == 3 and row.n_known == 0 and row.train_tokens == 0
    assert row.score == row.base_score == 0


def test_tokens_stop_at_text_borders():
    texts = pa.array(["ab", "cd  E", "", " x\n", "é"])
    tokens = tokenise(texts)
    names = np.array(tokens.words.to_pylist(), object)[tokens.codes].tolist()
    assert names == [BEGIN, "ab", END, BEGIN, "cd", "e", END, BEGIN, END, BEGIN, "x", END, BEGIN, "é", END]
    assert tokens.owner.tolist() == [0, 0, 0, 1, 1, 1, 1, 2, 2, 3, 3, 3, 4, 4, 4]
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", "b" * 50, "", "c"])], ["text"])
    assert [p.num_rows for p in text_pieces(batch, 0, 10)] == [1, 1, 2]
