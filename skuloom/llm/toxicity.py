"""Toxicity: a linear-chain conditional random field tags offending words."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import digest, discard, reach_workers, stored, text_of
from skuloom.llm.quality_model import held_out, training_ids

#: Labelled texts a model is fitted on, at most, and the labelled rows they are chosen from.
SAMPLE = 4_000
CHOSEN_FROM = 40_000
#: Hash buckets of the features.
BUCKETS = 1 << 18
_WORD = re.compile(r"[^\W_]+")
#: Log-likelihood ratios above which a word may count as offending; folds of the training texts choose.
LIMITS = (4, 8, 12, 16)
FOLDS = 4
#: Windows of this many words train the tagger, at most so many around offending words of a text.
_WINDOW = 32
PLACES = 8
#: Tasks that cut and count the sampled texts.
FITTED_IN = 12
_REMEMBERED = 300_000
_CHUNK = 1_000_000


def features(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word: the word, its beginnings and its ending."""
    names = (f"w{word}", f"a{word[:4]}", f"b{word[:5]}", f"c{word[:6]}", f"z{word[-4:]}")
    return tuple(zlib.crc32(n.encode()) % BUCKETS for n in names)


@dataclass
class Tagger:
    """Two tags, 0 and 1. ``weight`` favours tag 1; ``step`` scores the change between tags."""

    weight: np.ndarray
    bias: float
    step: np.ndarray  # (2, 2): from, to
    calibration: np.ndarray  # constant, largest, second largest and number of offending words
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.bias + float(self.weight[list(features(word))].sum())
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def marginals(self, emission: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability of tag 1 for each word of each text, by the forward-backward recursions.

        Texts stand one after another. They are laid out step by step, longest text first, so
        that each step is one operation over all texts that are long enough.
        """
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        longest = int(sizes.max(initial=0))
        active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
        begin = np.concatenate([[0], np.cumsum(active)])
        first = np.cumsum(sizes) - sizes
        text = np.repeat(np.arange(len(sizes)), sizes)
        when = np.arange(len(emission)) - first[text]
        place = begin[when] + rank[text]
        odds = np.empty(len(emission))
        odds[place] = np.exp(np.clip(emission, -30, 30))
        t = np.exp(self.step)
        forward = odds.copy()
        for k in range(1, longest):
            now, before = begin[k], forward[begin[k - 1] : begin[k - 1] + active[k]]
            forward[now : now + active[k]] *= (t[0, 1] + before * t[1, 1]) / (
                t[0, 0] + before * t[1, 0]
            )
        backward = np.ones(len(emission))
        for k in range(longest - 2, -1, -1):
            n = active[k + 1]
            after = slice(begin[k + 1], begin[k + 1] + n)
            ahead = odds[after] * backward[after]
            backward[begin[k] : begin[k] + n] = (t[1, 0] + ahead * t[1, 1]) / (
                t[0, 0] + ahead * t[0, 1]
            )
        ratio = (forward * backward)[place]
        return ratio / (1 + ratio)

    def summary(self, marginal: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per text: 1, logits of the two largest marginals, log of the offending words."""
        rows = np.zeros((len(sizes), 4))
        rows[:, 0] = 1
        ends = np.cumsum(sizes)
        for k, (stop, n) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
            own = marginal[stop - n : stop]
            if n == 0:
                top = np.zeros(2)
            else:
                top = np.sort(own)[-2:] if n > 1 else np.array([0.0, own[0]])
            top = np.clip(top, 1e-6, 1 - 1e-6)
            rows[k, 1], rows[k, 2] = np.log(top[1] / (1 - top[1])), np.log(top[0] / (1 - top[0]))
            rows[k, 3] = np.log1p((own > 0.5).sum())
        return rows

    def read(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Scores, marginals and sizes of consecutive stretches of texts."""
        at = 0
        while at < len(texts):
            words: list[str] = []
            sizes = []
            while at < len(texts) and len(words) < _CHUNK:
                own = _WORD.findall(texts[at].lower())
                words += own
                sizes.append(len(own))
                at += 1
            counts = np.array(sizes, np.int64)
            marginal = self.marginals(self.emissions(words), counts)
            logit = self.summary(marginal, counts) @ self.calibration
            yield 1 / (1 + np.exp(-np.clip(logit, -30, 30))), marginal, counts


def marked_buckets(inside: np.ndarray, outside: np.ndarray, n: int, m: int, limit: float) -> np.ndarray:
    """Which feature buckets mark offending words: far more frequent in toxic texts than in others.

    ``inside`` and ``outside`` count the toxic and the other texts that hold a bucket, ``n`` and
    ``m`` all of them. A bucket needs three toxic texts, and one in a hundred of them, odds of at
    least e**3, and a log-likelihood ratio above ``limit``, so that few labelled texts do not mark
    words by chance.
    """
    both = np.maximum(inside + outside, 1)
    odds = np.log((inside + 0.1) / (n + 1)) - np.log((outside + 0.1) / (m + 1))
    # log of the likelihood that the bucket is toxic at its own rate against the usual rate
    gain = inside * np.log(np.maximum(inside, 1) / both * (n + m) / max(n, 1))
    gain += outside * np.log(np.maximum(outside, 1) / both * (n + m) / max(m, 1))
    return (inside >= max(3, 0.01 * n)) & (odds > 3) & (gain > limit)


def window_slopes(
    weight: np.ndarray, bias: float, step: np.ndarray, names: np.ndarray, tags: np.ndarray, sizes: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of tagged windows, and its slopes by emission and by step.

    ``names`` (windows, words, features) and ``tags`` (windows, words) are padded behind ``sizes``
    words; what is padded takes no part.
    """
    n, length = tags.shape
    inside = np.arange(length) < sizes[:, None]
    emission = np.where(inside, bias + weight[names].sum(2), 0)
    e = np.stack([np.zeros_like(emission), emission], 2)
    alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    alpha[:, 0] = e[:, 0]
    for k in range(1, length):
        ahead = e[:, k] + np.logaddexp.reduce(alpha[:, k - 1, :, None] + step, axis=1)
        alpha[:, k] = np.where(inside[:, k, None], ahead, alpha[:, k - 1])
    for k in range(length - 2, -1, -1):
        behind = np.logaddexp.reduce(step + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
        beta[:, k] = np.where(inside[:, k + 1, None], behind, 0)
    whole = np.logaddexp.reduce(alpha[:, -1], axis=1)
    p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - whole[:, None])
    pairs = inside[:, 1:, None, None]
    both = alpha[:, :-1, :, None] + step + (e[:, 1:] + beta[:, 1:])[:, :, None, :]
    both = np.where(pairs, np.exp(both - whole[:, None, None, None]), 0)
    kind = np.eye(2)[tags.astype(int)]
    seen = kind[:, :-1, :, None] * kind[:, 1:, None, :] * pairs
    value = (tags * emission)[inside].sum() + (seen * step).sum() - whole.sum()
    return float(value), np.where(inside, tags - p, 0), (seen - both).sum((0, 1))


def _train(tagger: Tagger, names, tags, sizes, epochs: int, rng) -> None:
    """Adaptive gradient steps on the log-likelihood of the tags of the windows."""
    squares, step_squares, bias_square = np.full(BUCKETS, 1e-8), np.full((2, 2), 1e-8), 1e-8
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(names)), max(1, len(names) // 64)):
            own, n = names[part], len(part)
            _, miss, step_slope = window_slopes(
                tagger.weight, tagger.bias, tagger.step, own, tags[part], sizes[part]
            )
            used, place = np.unique(own, return_inverse=True)
            each = np.repeat(miss / n, own.shape[2], axis=1).ravel()
            slope = np.bincount(place.ravel(), each, len(used)) - 1e-4 * tagger.weight[used]
            squares[used] += slope**2
            tagger.weight[used] += 0.3 * slope / np.sqrt(squares[used])
            step_slope = step_slope / n - 1e-3 * tagger.step
            step_squares += step_slope**2
            tagger.step = tagger.step + 0.1 * step_slope / np.sqrt(step_squares)
            lean = miss.sum() / n
            bias_square += lean**2
            tagger.bias += 0.1 * lean / math.sqrt(bias_square)


def _calibrate(tagger: Tagger, rows: np.ndarray, toxic: np.ndarray) -> None:
    """Newton steps of a ridge logistic regression on the summaries of the texts."""
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(rows @ tagger.calibration, -30, 30)))
        slope = rows.T @ (p - toxic) + 0.05 * tagger.calibration
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 0.05 * np.eye(4)
        tagger.calibration = tagger.calibration - np.linalg.solve(curve, slope)


def _per_text(sample: DataFrame, work, schema: str) -> pa.Table:
    """``work(text, label, fold)`` of every sampled text, in the order of the texts' digests."""
    reach_workers(sample.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, *given = (c.to_pylist() for c in batch.columns)
            made = [work(*row) for row in zip(*given, strict=True)]
            columns = [pa.array(keys), *(pa.array(c) for c in zip(*made, strict=True))]
            if made:
                yield pa.RecordBatch.from_arrays(columns, ["sha", *names])

    found = sample.select("sha", "text", "label", "fold").mapInArrow(run, f"sha string, {schema}")
    return found.toArrow().sort_by("sha")


def _kinds(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct words of a text in order, and the buckets of each that may mark it."""
    kinds = sorted(set(words))
    return kinds, np.array([features(w)[:4] for w in kinds], np.int64).reshape(-1, 4)


def _bucket_counts(sample: DataFrame) -> np.ndarray:
    """(folds, labels, buckets): how many texts hold each bucket; counted in tasks."""
    reach_workers(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.zeros(0, np.int64)]
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.unique(_kinds(_WORD.findall(text.lower()))[1])
                cells.append((2 * fold + label) * BUCKETS + own)
            cell, n = np.unique(np.concatenate(cells), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    cells = sample.select("text", "label", "fold").mapInArrow(run, "cell long, n long")
    table = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * FOLDS * BUCKETS)
    counts[table["cell"].to_numpy()] = table["n"].to_numpy()
    return counts.reshape(FOLDS, 2, BUCKETS)


def choose_limit(sample: DataFrame, counts: np.ndarray, sizes: np.ndarray) -> float:
    """The evidence limit of ``LIMITS`` whose marks tell the texts of other folds best.

    Marks made from all folds but one are tried on that one: a text counts as found when it has a
    marked word. The largest F1 over all folds wins, of equals the largest limit.
    """
    masks = []
    for fold in range(FOLDS):
        (m, n), (outside, inside) = (x.sum(0) - x[fold] for x in (sizes, counts))
        marks = [marked_buckets(inside, outside, int(n), int(m), limit) for limit in LIMITS]
        masks.append(sum(mark.astype(np.uint8) << k for k, mark in enumerate(marks)))
    shared = sample.sparkSession.sparkContext.broadcast(np.stack(masks))

    def work(text: str, label: int, fold: int) -> tuple[int, int]:
        own = _kinds(_WORD.findall(text.lower()))[1]
        return label, int(np.bitwise_or.reduce(shared.value[fold][own.ravel()], initial=0))

    table = _per_text(sample, work, "label long, bits long")
    label, bits = (table[c].to_numpy() for c in ("label", "bits"))
    best = (-1.0, LIMITS[-1])
    for k, limit in enumerate(LIMITS):
        hit = bits >> k & 1
        f1 = 2 * (hit & label).sum() / max(1, hit.sum() + label.sum())
        best = max(best, (float(f1), limit))
    return best[1]


def _windows(sample: DataFrame, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, tags and sizes of the training windows; cut in tasks.

    ``PLACES`` of the offending words of a toxic text, drawn at random over the whole text, and
    three places of any text that has words. Texts shorter than a window are one padded window.
    """
    shared = sample.sparkSession.sparkContext.broadcast(marks)

    def work(text: str, label: int, fold: int) -> tuple[bytes, bytes, bytes]:
        words = _WORD.findall(text.lower())
        kinds, own = _kinds(words)
        bad = dict(zip(kinds, (label * shared.value[own].any(1)).tolist(), strict=True))
        tag = np.fromiter((bad[w] for w in words), np.uint8, len(words))
        rng = np.random.default_rng(zlib.crc32(text.encode()))
        spots = np.flatnonzero(tag)
        if len(spots) > PLACES:
            spots = rng.choice(spots, PLACES, replace=False)
        if words:
            spots = np.concatenate([spots, rng.integers(0, len(words), 3)])
        starts = np.clip(spots - _WINDOW // 2, 0, max(0, len(words) - _WINDOW)).tolist()
        starts = starts if len(words) > _WINDOW else starts[:1]
        names = np.zeros((len(starts), _WINDOW, 5), np.int32)
        tags = np.zeros((len(starts), _WINDOW), np.uint8)
        sizes = np.full(len(starts), min(len(words), _WINDOW), np.int32)
        for k, start in enumerate(starts):
            names[k, : sizes[k]] = [features(w) for w in words[start : start + _WINDOW]]
            tags[k, : sizes[k]] = tag[start : start + _WINDOW]
        return names.tobytes(), tags.tobytes(), sizes.tobytes()

    table = _per_text(sample, work, "names binary, tags binary, sizes binary")
    names, tags, sizes = (b"".join(table[c].to_pylist()) for c in ("names", "tags", "sizes"))
    return (
        np.frombuffer(names, np.int32).reshape(-1, _WINDOW, 5),
        np.frombuffer(tags, np.uint8).reshape(-1, _WINDOW),
        np.frombuffer(sizes, np.int32),
    )


def fit_tagger(sample: DataFrame, epochs: int = 12, seed: int = 7) -> Tagger:
    """A tagger from sampled texts: sha, text, label and fold, one row per text.

    Texts stay in tasks. The driver gets, per text, its window features (at most ``PLACES`` + 3
    windows) and four numbers, and one count per fold, label and bucket. Without toxic and other
    texts alike there is nothing to learn: scores are then the smoothed share of toxic texts.
    """
    sizes = np.zeros((FOLDS, 2))
    for row in sample.groupBy("fold", "label").count().collect():
        sizes[row["fold"], row["label"]] = row["count"]
    m, n = sizes.sum(0).tolist()
    share = (n + 0.5) / (n + m + 1)
    base = math.log(share / (1 - share))
    tagger = Tagger(np.zeros(BUCKETS), -6.0, np.zeros((2, 2)), np.array([base, 0, 0, 0]))
    if not n or not m:
        return tagger
    counts = _bucket_counts(sample)
    limit = choose_limit(sample, counts, sizes)
    outside, inside = counts.sum(0)
    marks = marked_buckets(inside, outside, int(n), int(m), limit)
    names, tags, lengths = _windows(sample, marks)
    if len(names):
        _train(tagger, names, tags, lengths, epochs, np.random.default_rng(seed))
    shared = sample.sparkSession.sparkContext.broadcast(tagger)

    def work(text: str, label: int, fold: int) -> tuple[int, bytes]:
        ((_, marginal, count),) = shared.value.read([text])
        return label, shared.value.summary(marginal, count).tobytes()

    table = _per_text(sample, work, "label long, summary binary")
    rows = np.frombuffer(b"".join(table["summary"].to_pylist())).reshape(-1, 4)
    _calibrate(tagger, rows, table["label"].to_numpy().astype(np.float64))
    return tagger


def fit_from_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger:
    """A tagger from at most ``sample`` labelled texts, up to half of them toxic.

    Held-out rows are never read for labels, also not for the choice of the evidence limit, which
    folds of the training texts decide. Of rows with one id the text with the smallest digest
    counts, copies of one text count once, with the label of the smallest id.
    """
    ids = training_ids(labels, "toxic", CHOSEN_FROM)
    rank = F.xxhash64("doc_id")
    parts = [
        ids.where(f"label = {k}").orderBy(rank, "doc_id").limit(sample // 2) for k in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select(docs["doc_id"], text_of(docs).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    one = rows.groupBy("doc_id").agg(
        F.min(F.struct(digest(F.col("text")).alias("sha"), "text", "label")).alias("row")
    )
    texts = one.groupBy("row.sha").agg(
        F.min(F.struct("doc_id", F.col("row.label").cast("int").alias("label"), "row.text")).alias("row")
    )
    texts = texts.select(
        "sha", "row.text", "row.label", F.pmod(F.crc32("sha"), F.lit(FOLDS)).cast("int").alias("fold")
    )
    kept = stored(texts.repartition(FITTED_IN, "sha"), "toxicity-sample")
    tagger = fit_tagger(kept)
    discard(kept)
    return tagger


def toxic_spans(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, score and ``spans``: character offsets [begin, end) of runs of offending words.

    A word offends when its marginal exceeds one half. Null and empty texts have no words; their
    score is what the calibration gives a text without any.
    """
    reach_workers(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, spans, k = [], [], 0
            for score, marginal, sizes in model.read(texts):
                scores += score.tolist()
                at = 0
                for n in sizes.tolist():
                    spans.append(_runs(texts[k], np.flatnonzero(marginal[at : at + n] > 0.5)))
                    at, k = at + n, k + 1
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                ["doc_id", "score", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], text_of(docs)).mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<begin:int,end:int>>"
    )


def _runs(text: str, bad: np.ndarray) -> list[dict[str, int]]:
    if not len(bad):
        return []
    lower = text.lower()
    source = text if len(lower) == len(text) else lower  # a few letters change length
    places = [m.span() for m in _WORD.finditer(source.lower())]
    runs: list[dict[str, int]] = []
    last = -2
    for k in bad.tolist():
        if k == last + 1:
            runs[-1]["end"] = places[k][1]
        else:
            runs.append({"begin": places[k][0], "end": places[k][1]})
        last = k
    return runs


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, limit: float = 0.5, sample: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of offending spans of every document.

    Labels that are null or have no document are passed over. Repeated rows and null ids give a
    row each, and equal texts equal scores. An empty table gives no rows. Texts of any length are
    scored whole: the longest one of a task must fit into its memory as words.
    """
    found = toxic_spans(docs, fit_from_labels(docs, labels, sample))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(limit)).cast("int").alias("predicted"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )
