"""Spelling variants: words one edit apart, found by dense prefix-suffix comparison of tiles."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import reach_workers, stored, text_of

#: Letters are A-Z, a-z and U+00C0 to U+00FF, all of them below 256: a word is an array of bytes.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Code points read at a time, pairs times width compared at a time, cells hashed at a time.
_PIECE, _TILE, _CELLS = 4 << 20, 8 << 20, 1 << 20
#: Words of a bucket that are compared as they are; larger buckets are keyed more narrowly.
BUCKET = 2048
_PARTS = 8
_CODES = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROW = "key bigint, word string, n bigint, longer boolean, low int, high int"
_FOUND = f"{_ROW}, other string, other_n bigint"


def _text_pieces(texts: list[bytes], size: int = _PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Stretches of whole texts, about ``size`` bytes each, with the index of the first."""
    first = total = 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield first, texts[first : k + 1]
            first, total = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _runs(texts: list[bytes]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Text index and lower-cased word of every run of letters, in order."""
    flat = [t.decode("utf-8", "replace").encode("latin-1", "replace") for t in texts]
    raw = np.frombuffer(b"\n".join(flat) + b"\n", np.uint8)
    letter = _LETTER[raw]
    edges = np.flatnonzero(np.diff(letter, prepend=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(sizes, out=at[1:])
    kept = _LOWER[raw[letter]]
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(kept)]
    )
    lines = np.cumsum([0] + [len(t) + 1 for t in flat[:-1]])
    return np.searchsorted(lines, starts, side="right") - 1, words.dictionary_encode()


def word_counts(docs: DataFrame, noise: int = 31, least_length: int = 7) -> DataFrame:
    """(word, n) of all texts, where one in ``noise`` (text, run) pairs loses a code point.

    A run is lower-cased in A-Z only. With h the checksum of ``<doc_id>:<run>``, the code point at
    h modulo its length goes when ``noise`` divides h. Counts of a stretch of texts are added up in
    the task before they are shuffled. Null texts have no words; a null id is an empty one.
    """
    reach_workers(docs.sparkSession)

    def count(texts: list[bytes], ids: list[str]) -> dict[bytes, int]:
        owner, words = _runs(texts)
        plain = words.dictionary.to_pylist()
        if not plain:
            return {}
        names = [w.decode("latin-1").encode() for w in plain]
        begins = [zlib.crc32(f"{i}:".encode()) for i in ids]
        pairs, times = np.unique(
            owner * len(plain) + words.indices.to_numpy(), return_counts=True
        )
        text, word = np.divmod(pairs, len(plain))
        checks = np.fromiter(
            (
                zlib.crc32(names[w], begins[t])
                for t, w in zip(text.tolist(), word.tolist(), strict=True)
            ),
            np.int64,
            len(pairs),
        )
        hit = checks % noise == 0
        totals = np.bincount(word[~hit], times[~hit], len(plain)).astype(np.int64)
        found: Counter = Counter()
        for k in np.flatnonzero(totals).tolist():
            if len(plain[k]) >= least_length:
                found[plain[k]] = int(totals[k])
        for k, h, n in zip(word[hit].tolist(), checks[hit].tolist(), times[hit].tolist(), strict=True):
            own = plain[k]
            if len(own) > least_length:
                gone = h % len(own)
                found[own[:gone] + own[gone + 1 :]] += n
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in _text_pieces(batch.column(1).cast(pa.binary()).to_pylist()):
                found = count(texts, ids[first : first + len(texts)])
                words = pa.array([w.decode("latin-1") for w in found], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [words, pa.array(found.values(), pa.int64())], ["word", "n"]
                )

    own_id = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    found = docs.select(own_id, text_of(docs)).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _batch(words, n, key, longer, low, high) -> pa.RecordBatch:
    size = len(words)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key, pa.int64()),
            pa.array(words, pa.string()),
            pa.array(n, pa.int64()),
            pa.array(longer, pa.bool_()),
            pa.array(low, pa.int32()),
            pa.array(high, pa.int32()),
            pa.nulls(size, pa.string()),
            pa.nulls(size, pa.int64()),
        ],
        _FOUND.replace(",", "").split()[::2],
    )


def _cuts(low: int, high: int) -> np.ndarray:
    """Bounds of the parts of a span: about three code points each, at most ``_PARTS`` parts."""
    span = high - low
    parts = span if span <= 3 else min(_PARTS, -(-span // 3))
    return low + np.arange(parts + 1) * span // parts


def keyed(
    words: list[str], n: np.ndarray, longer: np.ndarray, low: np.ndarray, high: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """A row for each part of the span [low, high) of each word, keyed by all outside that part.

    Places are those of the shorter word of a pair; the ``longer`` one has one code point more
    in the part. Two words whose edit lies in a part agree outside of it, so they share its key.
    The key is a 64-bit polynomial hash of the code points before and behind the part.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.lexsort((high, low, longer, sizes))
    columns = np.stack([sizes, longer.astype(np.int64), low, high])[:, order]
    new = np.flatnonzero((np.diff(columns, axis=1) != 0).any(0)) + 1
    for group in np.split(order, new):
        if not len(group):
            continue
        size, extra = int(sizes[group[0]]), int(longer[group[0]])
        cuts = _cuts(int(low[group[0]]), int(high[group[0]]))
        power = np.cumprod(np.full(size, _BASE, np.uint64))
        for part in np.array_split(group, -(-len(group) * size // _CELLS)):
            own = [words[k] for k in part]
            codes = _CODES[np.frombuffer("".join(own).encode("latin-1"), np.uint8)]
            codes = codes.reshape(len(own), size)
            before = np.zeros((len(own), size + 1), np.uint64)
            behind = np.zeros((len(own), size + 1), np.uint64)
            np.cumsum(codes * power, axis=1, out=before[:, 1:])
            np.cumsum(codes[:, ::-1] * power, axis=1, out=behind[:, 1:])
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                key = before[:, begin] * _CODES[1] + behind[:, size - end - extra] * _CODES[2]
                place = ((size - extra) << 20 | begin) * int(_CODES[3]) % (1 << 64)
                key = (key + np.uint64(place)) * _BASE
                key ^= key >> np.uint64(29)
                same = np.full(len(own), True)
                yield _batch(own, n[part], key.view(np.int64), same & bool(extra),
                             same * begin, same * end)


def _first_keys(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Keys of every word as the shorter one (or equal), and as the longer one of a pair."""
    for batch in batches:
        words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        sizes = np.array([len(w) for w in words], np.int64)
        zero = np.zeros(len(words), np.int64)
        yield from keyed(words, n, zero.astype(bool), zero, sizes)
        more = np.flatnonzero(sizes > least)
        own = [words[k] for k in more]
        yield from keyed(own, n[more], zero[more] == 0, zero[more], sizes[more] - 1)


class Tiles:
    """Compares the words of equal keys; buckets that are too large get narrower keys instead."""

    def __init__(self, table: pa.Table) -> None:
        self.words = table["word"].to_pylist()
        self.key = table["key"].to_numpy()
        self.n = table["n"].to_numpy()
        self.longer = table["longer"].to_numpy()
        self.low, self.high = table["low"].to_numpy(), table["high"].to_numpy()
        self.sizes = np.array([len(w) for w in self.words], np.int64)

    def narrower(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = [self.words[k] for k in rows]
        yield from keyed(own, self.n[rows], self.longer[rows], self.low[rows], self.high[rows])

    def compare(self) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.diff(self.key, prepend=self.key[:1] ^ 1) != 0)
        ends = np.append(starts[1:], len(self.key))
        wide = np.maximum.reduceat(self.high - self.low, starts)
        large = (ends - starts > BUCKET) & (wide > 1)
        for k in np.flatnonzero(large).tolist():
            yield from self.narrower(np.arange(starts[k], ends[k]))
        some = ~large & (ends - starts > 1)
        if not some.any():
            return
        starts, ends = starts[some], ends[some]
        longest = np.array([self.sizes[a:b].max() for a, b in zip(starts, ends, strict=True)])
        width = 1 << np.ceil(np.log2(longest)).astype(np.int64)
        for w in np.unique(width).tolist():
            own = width == w
            yield from self._tile(starts[own], ends[own], w)

    def _tile(self, starts: np.ndarray, ends: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
        """All pairs inside buckets of words of at most ``width`` code points."""
        counts = ends - starts
        rows = np.repeat(starts - np.append(0, np.cumsum(counts)[:-1]), counts)
        rows += np.arange(counts.sum())
        own = [self.words[row].encode("latin-1") for row in rows.tolist()]
        padded = (b"".join([w.ljust(width) for w in own]), b"".join([w[::-1].ljust(width) for w in own]))
        left, right = (np.frombuffer(p, np.uint8).reshape(len(own), width) for p in padded)
        behind = np.repeat(ends, counts) - rows - 1  # partners after each row, in its bucket
        done, size = 0, max(1, _TILE // width)
        while done < len(rows):
            upto = max(done + 1, np.searchsorted(np.cumsum(behind[done:]), size, "right") + done)
            a = np.repeat(np.arange(done, upto), behind[done:upto])
            first = np.cumsum(behind[done:upto]) - behind[done:upto]
            b = a + 1 + np.arange(len(a)) - np.repeat(first, behind[done:upto])
            done = upto
            x, y = rows[a], rows[b]
            both = self.longer[x] & self.longer[y]
            base = self.sizes - self.longer
            fit = ~both & (base[x] == base[y])
            yield self._links(x[fit], y[fit], left, right, a[fit], b[fit])

    def _links(self, x, y, left, right, a, b) -> pa.RecordBatch:
        """Pairs whose common prefix and suffix reach the longer length less one."""
        least = np.minimum(self.sizes[x], self.sizes[y])
        most = np.maximum(self.sizes[x], self.sizes[y])

        def common(matrix: np.ndarray) -> np.ndarray:
            differ = matrix[a] != matrix[b]
            at = differ.argmax(1)
            return np.minimum(np.where(differ.any(1), at, matrix.shape[1]), least)

        prefix = common(left)
        near = (prefix + common(right) >= most - 1) & (prefix < most)
        # the first place after the common prefix lies in one part only: each pair counts once
        inside = (self.low[x] <= prefix) & (
            (prefix < self.high[x]) | ((prefix == least) & (self.high[x] == least))
        )
        x, y = x[near & inside], y[near & inside]
        one, two = np.append(x, y), np.append(y, x)
        pick = lambda rows: pa.array([self.words[k] for k in rows], pa.string())
        nothing = pa.nulls(len(one), pa.int64())
        return pa.RecordBatch.from_arrays(
            [nothing, pick(one), nothing, nothing.cast(pa.bool_()), nothing.cast(pa.int32()),
             nothing.cast(pa.int32()), pick(two), pa.array(self.n[two], pa.int64())],
            _FOUND.replace(",", "").split()[::2],
        )


def _compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by key; a bucket may spread over batches, but few rows ever wait.

    What waits is at most one bucket: of BUCKET rows, or of words that differ in a single place,
    which the alphabet bounds.
    """
    carry: pa.Table | None = None
    spread: int | None = None  # key of a large bucket whose rows all get narrower keys
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        if not table.num_rows:
            continue
        key = table["key"].to_numpy()
        if spread is not None:
            upto = int(np.searchsorted(key, spread, side="right"))
            yield from Tiles(table.slice(0, upto)).narrower(np.arange(upto))
            table, key = table.slice(upto), key[upto:]
            if not len(key):
                carry = None
                continue
            spread = None
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield from Tiles(table.slice(0, cut)).compare()
        carry = table.slice(cut)
        if carry.num_rows > BUCKET:
            bucket = Tiles(carry)
            if (bucket.high - bucket.low).max() > 1:
                yield from bucket.narrower(np.arange(carry.num_rows))
                carry, spread = None, int(key[-1])
    if carry is not None and carry.num_rows:
        yield from Tiles(carry).compare()


def near_words(words: DataFrame, least_length: int = 7) -> DataFrame:
    """(word, other, other_n): every pair of words one edit apart, from both sides.

    ``words`` has each word once, with its count ``n``. Words that may differ in a part share the
    key of all outside that part; the pairs of a key are compared in dense tiles. Buckets of more
    than ``BUCKET`` words go into another round with narrower parts, down to a single code point, so
    neither a task nor a tile depends on how many words resemble each other.
    """
    reach_workers(words.sparkSession)
    rows = words.select("word", "n").mapInArrow(lambda b: _first_keys(b, least_length), _FOUND)
    found = None
    while True:
        sorted_rows = rows.repartition("key").sortWithinPartitions("key")
        out = stored(sorted_rows.mapInArrow(_compare_sorted, _FOUND), "spelling")
        links = out.where("key is null").select("word", "other", "other_n")
        found = links if found is None else found.unionByName(links)
        rows = out.where("key is not null")
        if rows.isEmpty():
            return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead to, by doubling the steps until none goes further."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.join(on, "root", "left")
        if joined.where("further is not null").isEmpty():
            return steps
        steps = stored(
            joined.select("word", F.coalesce("further", "root").alias("root")), "roots"
        )


def spelling_variants(
    docs: DataFrame, least_length: int = 7, least_n: int = 2, factor: int = 10, noise: int = 31
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n and root.

    Words are those of ``word_counts`` with ``least_length`` code points and ``least_n`` occurrences
    or more. ``form`` is the near word of largest n (ties: the smallest) if it is ``factor`` times as
    frequent, else null; ``root`` is where the forms lead to. Empty tables, null and empty texts
    have no words; repeated rows count again; very long texts are one stretch of their own. Extra
    columns are not read. A word of more than 24 letters has eight parts, so it is repeated at
    most 16 times before the shuffle.
    """
    counts = word_counts(docs, noise, least_length)
    words = stored(counts.where(F.col("n") >= least_n), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other"))).alias("best")
    near = near_words(words, least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best
    )
    best_n = -F.col("best.minus_n")
    frequent = best_n >= F.lit(factor) * F.col("n")
    table = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.other")).alias("form"),
            F.when(frequent, best_n).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(table.where("form is not null"))
    return table.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
