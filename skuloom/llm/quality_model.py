"""Quality classifier: histogram gradient-boosted trees over statistics of a document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import reach_workers, stored, text_of
from skuloom.llm.quality_rules import repeated_words

#: Labelled rows that a model is fitted on, at most; they are taken in the order of a hash.
SAMPLE = 20_000
FEATURES = (
    "log_bytes log_words word_length word_spread longest_word distinct_words top_word short_words "
    "log_lines line_length repeated_lines repeated_words upper digits blanks marks symbols "
    "exclaim stops commas high_bytes entropy upper_words odd_words long_words ends_in_sign "
    "no_vowel distinct_bytes"
).split()
_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~=+_{}[]\\/", np.uint8)
_MARKS = np.frombuffer(b".,;:!?'\"()-", np.uint8)


def statistics(text: str) -> list[float]:
    """The numbers a document is judged by; an empty text gives zeros."""
    raw = text.encode()
    if not raw:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / len(raw)
    some = share[share > 0]
    words = text.split()
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    kinds = Counter(words)
    lines = text.split("\n")
    signs = sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,;:!?\"')")
    odd = sum(1 for w in words if not w.isalpha())
    capital = sum(1 for w in words if w.isupper())
    plain = sum(1 for w in kinds if not set(w.lower()) & set("aeiouyäöüéèêáíóú"))
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        sizes.mean(),
        sizes.std(),
        sizes.max(),
        len(kinds) / n,
        max(kinds.values(), default=0) / n,
        float((sizes <= 3).mean()),
        np.log1p(len(lines)),
        len(text) / len(lines),
        1 - len(set(lines)) / len(lines),
        repeated_words(words) / n,
        share[65:91].sum(),
        share[48:58].sum(),
        share[32] + share[9:14].sum(),
        share[_MARKS].sum(),
        share[_SYMBOLS].sum(),
        share[33],
        share[46],
        share[44],
        share[128:].sum(),
        float(-(some * np.log(some)).sum()),
        capital / n,
        odd / n,
        float((sizes > 15).mean()),
        signs / n,
        plain / max(1, len(kinds)),
        len(some) / 256,
    ]


@dataclass(frozen=True)
class Trees:
    """Complete trees as arrays: node k of a tree has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray  # (trees, inner nodes)
    limit: np.ndarray  # (trees, inner nodes); larger values go right
    leaf: np.ndarray  # (trees, leaves)
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all trees walked level by level at once."""
        trees, inner = self.feature.shape
        if not trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        at = np.zeros((len(x), trees), np.int64)
        each = np.arange(trees)
        while at[0, 0] < inner:
            right = np.take_along_axis(x, self.feature[each, at], 1) > self.limit[each, at]
            at = 2 * at + 1 + right
        total = self.start + self.leaf[each, at - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 1.0,
) -> Trees:
    """Boosting of the logistic loss on binned features.

    Each level sums gradients and curvatures by (node, feature, bin) and cuts where the gain is
    largest. One class alone, or no rows, gives the constant score of that class' smoothed share.
    """
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        empty = np.zeros((0, inner))
        return Trees(empty.astype(np.int64), empty, np.zeros((0, leaves)), start)
    cuts = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)
    binned = np.stack([np.searchsorted(cuts[:, f], x[:, f]) for f in range(width)], 1)
    columns = np.arange(width) * bins
    total = np.full(n, start)
    features, limits, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, curve = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * bins) + columns + binned).ravel()
            shape = (nodes, width, bins)
            g = np.bincount(cell, np.repeat(gradient, width), nodes * width * bins).reshape(shape)
            h = np.bincount(cell, np.repeat(curve, width), nodes * width * bins).reshape(shape)
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            ga, ha = g.sum(2)[:, :, None], h.sum(2)[:, :, None]
            gr, hr = ga - gl, ha - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - ga**2 / (ha + ridge)
            gain[(hl < least) | (hr < least)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            worth = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            f, b = best // (bins - 1), best % (bins - 1)
            feature[first : first + nodes] = f
            limit[first : first + nodes] = np.where(worth, cuts[b, f], np.inf)
            own = node - first
            right = x[np.arange(n), f[own]] > limit[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        value = -rate * np.bincount(leaf, gradient, leaves) / (
            np.bincount(leaf, curve, leaves) + ridge
        )
        total += value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(np.array(features), np.array(limits), np.array(values), start)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may see: checksum of the id's text divisible by five."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 0


def training_ids(labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, label) of at most ``most`` rows that are not held out, in the order of a hash."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return (
        known.where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of its whole text; null counts as empty."""
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"], text_of(docs))
    return rows.mapInArrow(run, f"doc_id {kind}, x array<double>")


def quality_scores(
    docs: DataFrame, labels: DataFrame, limit: float = 0.3, sample: int = SAMPLE
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    The trees are fitted on the statistics of at most ``sample`` labelled rows that are not held
    out; only those reach the driver, and only the trees go back. Labels that are null or have no
    document are passed over; without labels every score is 0.5. Repeated rows and null ids give a
    row each, null and empty texts are scored by their statistics, which are zeros.
    """
    spark = docs.sparkSession
    rows = stored(document_statistics(docs), "statistics")
    ids = training_ids(labels, "quality", sample)
    known = rows.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    table = known.orderBy("doc_id").select("x", "label").toPandas()
    x = np.array(table["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    trees = spark.sparkContext.broadcast(fit_trees(x, table["label"].to_numpy(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x = np.array(part.column(1).to_pylist(), np.float64).reshape(-1, len(FEATURES))
                score = pa.array(trees.value.score(x))
                yield pa.RecordBatch.from_arrays([part.column(0), score], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(limit)).cast("int").alias("predicted"),
    )
