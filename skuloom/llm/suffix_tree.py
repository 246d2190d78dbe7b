"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import discard, reach_workers, stored, text_of

#: Words never contain blanks, so these two cannot clash with one.
BEGIN, END = "", "\n"
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text read at a time, and about so many places that a task has at once.
_PIECE, _PLACES = 4 << 20, 1 << 19
#: Numbers in the vocabulary of BEGIN, END and the first word.
_BEGIN, _END, _FIRST = 0, 1, 2


@dataclass(frozen=True)
class TreeLimits:
    """What the tree holds.

    Every string of words that occurs ``least`` times in the training texts, wherever and however
    rare, is an edge; there is no other limit to their number. A context of up to ``depth`` words is
    retained if its next-word distribution diverges from that of its suffix by ``divergence`` nats a
    token and by ``gain`` nats in all. ``discount`` is taken off each count and left to the shorter
    context.
    """

    depth: int = 3
    least: int = 1
    divergence: float = 0.01
    gain: float = 10.0
    discount: float = 0.5

    def support(self, tokens: int) -> int:
        """The least count of a string, the same for any number of training tokens."""
        return max(self.least, 1)


def text_pieces(batch: pa.RecordBatch, column: int, size: int = _PIECE) -> Iterator[pa.RecordBatch]:
    """Stretches of whole rows with about ``size`` bytes of text each."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        limit = (ends[first - 1] if first else 0) + size
        upto = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(first, upto - first)
        first = upto


@dataclass
class Tokens:
    """The words of some texts in order, each text between BEGIN and END.

    ``codes`` are places in ``words``, whose last two are BEGIN and END; ``owner`` is the text of
    each; ``real`` marks all but the BEGINs.
    """

    words: pa.Array
    codes: np.ndarray
    owner: np.ndarray
    real: np.ndarray


def tokenise(texts: pa.Array) -> Tokens:
    """Runs of characters that are no blanks, lower-cased in A-Z only."""
    n = len(texts)
    sizes = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    inside = ~_BLANK[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[begins] = True
    starts = np.flatnonzero(inside & (first[:-1] | ~np.append(False, inside[:-1])))
    stops = np.flatnonzero(inside & (first[1:] | ~np.append(inside[1:], False))) + 1
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=at[1:])
    kept = _LOWER[raw[inside]]
    words = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(kept)]
    ).dictionary_encode()
    text = np.searchsorted(begins, starts, side="right") - 1
    counts = np.bincount(text, minlength=n)
    last = len(words.dictionary)
    codes = np.full(len(starts) + 2 * n, last, np.int64)
    place = np.arange(len(starts)) + 2 * text + 1
    codes[place] = words.indices.to_numpy()
    ends = np.cumsum(counts + 2) - 1
    codes[ends] = last + 1
    real = np.ones(len(codes), bool)
    real[ends - counts - 1] = False
    return Tokens(
        pa.concat_arrays([words.dictionary, pa.array([BEGIN, END])]),
        codes,
        np.repeat(np.arange(n), counts + 2),
        real,
    )


def _pack(*columns: np.ndarray) -> bytes:
    """Whole numbers, byte by byte and compressed; lengths and widths lead."""
    head, planes = [0, len(columns)], []
    for values in columns:
        small = not len(values) or -(2**31) <= values.min() and values.max() < 2**31
        width = 4 if small else 8
        plain = np.ascontiguousarray(values, f"<i{width}").view(np.uint8).reshape(-1, width)
        planes.append(np.ascontiguousarray(plain.T).tobytes())
        head += [len(values), width]
    data = pa.compress(b"".join(planes), codec="zstd", asbytes=True)
    head[0] = len(data)
    return np.array(head, "<i4").tobytes() + data


def _unpack(data: bytes) -> list[np.ndarray]:
    size, k = np.frombuffer(data, "<i4", 2).tolist()
    shapes = np.frombuffer(data, "<i4", 2 * k, 8).reshape(k, 2).tolist()
    length = sum(n * width for n, width in shapes)
    plain = pa.decompress(data[8 + 8 * k :], length, codec="zstd", asbytes=True) if length else b""
    found, at = [], 0
    for n, width in shapes:
        planes = np.frombuffer(plain, np.uint8, n * width, at).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).view(f"<i{width}").ravel().astype(np.int64))
        at += n * width
    return found


def _joined(words: pa.Array) -> bytes:
    """Words, which hold no line feed, with one behind each."""
    ends = pa.array([0, len(words)], pa.int32())
    whole = pa.ListArray.from_arrays(ends, words.cast(pa.string()))
    return pc.binary_join(whole, END)[0].as_buffer().to_pybytes() + END.encode() * (len(words) > 0)


def _split(data: bytes) -> pa.Array:
    raw = np.frombuffer(data, np.uint8)
    feeds = raw == 10
    at = np.append(0, np.flatnonzero(feeds) - np.arange(np.count_nonzero(feeds))).astype(np.int64)
    buffers = [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw[~feeds]))]
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, buffers)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Numbers whose remainders spread evenly."""
    x = values.astype(np.uint64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _word_sums(words: pa.Array) -> np.ndarray:
    """A checksum of each word of an array that ``_split`` made."""
    at = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
    raw = np.frombuffer(words.buffers()[2], np.uint8, at[-1]).astype(np.uint64)
    place = np.arange(len(raw)) - np.repeat(at[:-1], np.diff(at))
    powers = np.cumprod(np.full(int(place.max(initial=0)) + 1, 1099511628211, np.uint64))
    return np.add.reduceat(raw * powers[place], at[:-1]) if len(words) else np.zeros(0, np.uint64)


def _slices(values: np.ndarray, parts: int) -> list[np.ndarray]:
    """Places of the rows of each part, in order; equal values have the same part."""
    part = (_mixed(values) % np.uint64(parts)).astype(np.int64)
    bits = len(part).bit_length()
    order = np.sort((part << bits) | np.arange(len(part))) & ((1 << bits) - 1)
    return np.split(order, np.cumsum(np.bincount(part, minlength=parts))[:-1])


def _groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each row, in the order of the codes, which are not negative; the first row of each."""
    bits = len(codes).bit_length()
    if int(codes.max(initial=0)) >> (63 - bits):
        order = np.argsort(codes, kind="stable")
        sorted_ = codes[order]
    else:  # numbers are sorted much faster than places
        sorted_ = np.sort((codes << bits) | np.arange(len(codes)))
        order = sorted_ & ((1 << bits) - 1)
        sorted_ >>= bits
    fresh = np.ones(len(codes), bool)
    np.not_equal(sorted_[1:], sorted_[:-1], out=fresh[1:])
    group = np.empty(len(codes), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group, order[fresh]


def _groups_but(codes: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_groups``, where some rows are known to be alone in theirs, so that they need no sort."""
    some, others = np.flatnonzero(~alone), np.flatnonzero(alone)
    group = np.empty(len(codes), np.int64)
    group[some], first = _groups(codes[some])
    group[others] = len(first) + np.arange(len(others))
    return group, np.append(some[first], others)


def _rows(docs: DataFrame, part: int, parts: int) -> DataFrame:
    """text, doc_id and whether the row is held out of the training."""
    own_id = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    out = F.crc32(own_id.cast("binary")) % F.lit(parts) == F.lit(part)
    return docs.select(text_of(docs).alias("text"), docs["doc_id"], out.alias("held_out"))


def token_pieces(rows: DataFrame) -> DataFrame:
    """Pieces of whole texts: their different words, and the places of all tokens among these.

    ``counts`` has the occurrences of the words in training texts, and in all texts. ``tokens``,
    ``train`` and ``texts`` count tokens, training texts and texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in text_pieces(batch, 0):
                tokens = tokenise(piece.column(0))
                size = len(tokens.words)
                train = ~piece.column(2).to_numpy(zero_copy_only=False)
                n = np.bincount(tokens.codes[train[tokens.owner]], minlength=size)
                seen = np.bincount(tokens.codes, minlength=size)
                own = {
                    "piece": (task << 32) + number,
                    "tokens": int(tokens.real.sum()),
                    "train": int(train.sum()),
                    "texts": piece.num_rows,
                    "words": _joined(tokens.words[: size - 2]),
                    "counts": _pack(n[: size - 2], seen[: size - 2]),
                    "codes": _pack(tokens.codes),
                }
                number += 1
                whole = pa.array([0, piece.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(whole, c) for c in piece.columns[1:]]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([x]) for x in own.values()), *lists], [*own, "doc_id", "held_out"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        "piece bigint, tokens bigint, train bigint, texts bigint, words binary, counts binary, "
        f"codes binary, doc_id array<{kind}>, held_out array<boolean>",
    )


_ASK, _REPLY = "part int, piece bigint, data binary", "piece bigint, part int, data binary"


def _asks(part: list, piece: int, data: list) -> pa.RecordBatch:
    columns = [(part, pa.int32()), ([piece] * len(part), pa.int64()), (data, pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(*c) for c in columns], ["part", "piece", "data"])


def word_table(pieces: DataFrame, parts: int) -> DataFrame:
    """For each piece and part of the vocabulary, the numbers and training counts of its words.

    A part of the vocabulary numbers and counts its words over all pieces. ``tokens`` and
    ``distinct`` add up to the training tokens and different ones, but for the ends of texts;
    ``hot`` has the words that occur ``_PLACES`` times in all texts.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, (n, seen) = _split(row["words"]), _unpack(row["counts"])
                own = _slices(_word_sums(words), parts)
                full = [k for k in range(parts) if len(own[k])]
                order = np.concatenate([np.zeros(0, np.int64), *own])
                texts = _joined(words.take(pa.array(order)))
                sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)[order] + 1
                ends = np.append(0, np.cumsum(sizes))[np.cumsum([0, *map(len, own)])]
                data = []
                for k in full:
                    counts = _pack(n[own[k]], seen[own[k]])
                    data.append(len(counts).to_bytes(4) + counts + texts[ends[k] : ends[k + 1]])
                yield _asks(full, row["piece"], data)

    def count(asked: pa.Table) -> pa.Table:
        data = asked["data"].to_pylist()
        ends = [4 + int.from_bytes(x[:4]) for x in data]
        counts = [_unpack(x[4:end]) for x, end in zip(data, ends, strict=True)]
        coded = pa.concat_arrays([_split(x[end:]) for x, end in zip(data, ends, strict=True)])
        coded = coded.dictionary_encode()
        code, size = coded.indices.to_numpy(), len(coded.dictionary)
        n, seen = (np.zeros(size, np.int64) for _ in range(2))
        np.add.at(n, code, np.concatenate([x[0] for x in counts]))
        np.add.at(seen, code, np.concatenate([x[1] for x in counts]))
        rank = np.empty(size, np.int64)  # frequent words get small numbers, which pack better
        rank[np.argsort(-seen, kind="stable")] = np.arange(size)
        number = rank * parts + asked["part"][0].as_py() + _FIRST
        often = seen >= _PLACES
        more = [None] * (len(data) - 1)
        cuts = np.cumsum([len(x[0]) for x in counts])[:-1]
        return pa.table(
            {
                "piece": asked["piece"],
                "part": asked["part"],
                "data": pa.array([_pack(number[c], n[c]) for c in np.split(code, cuts)], pa.binary()),
                "tokens": pa.array([int(n.sum()), *more], pa.int64()),
                "distinct": pa.array([int((n > 0).sum()), *more], pa.int64()),
                "top": pa.array([int(number.max()), *more], pa.int64()),
                "hot": pa.array([number[often].tolist(), *more], pa.list_(pa.int64())),
            }
        )

    asked = pieces.select("piece", "words", "counts").mapInArrow(ask, _ASK)
    return asked.groupBy("part").applyInArrow(
        count,
        f"{_REPLY}, tokens bigint, distinct bigint, top bigint, hot array<bigint>",
    )


@dataclass
class Vocabulary:
    """Training tokens, different ones among them, and a limit to the numbers of words."""

    tokens: int
    distinct: int
    width: int

    def base(self, n: np.ndarray) -> np.ndarray:
        """Probability of a token that occurs ``n`` times in the training texts."""
        return (n + 1) / (self.tokens + self.distinct + 1)


def numbered_pieces(pieces: DataFrame, table: DataFrame, parts: int, train: int) -> DataFrame:
    """The pieces with the numbers and training counts of their words in the place of the words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (piece,) = left.select(["words"]).to_pylist()
        words = _split(piece["words"])
        number, n = (np.zeros(len(words) + 2, np.int64) for _ in range(2))
        own = _slices(_word_sums(words), parts)
        for part, data in zip(right["part"].to_pylist(), right["data"].to_pylist(), strict=True):
            number[own[part]], n[own[part]] = _unpack(data)
        number[-2:], n[-1] = (_BEGIN, _END), train
        return left.drop_columns(["words"]).append_column("words", [[_pack(number, n)]])

    kept = pieces.select("piece", "codes", "doc_id", "held_out", "words")
    replies = table.select("piece", "part", "data")
    return kept.groupBy("piece").cogroup(replies.groupBy("piece")).applyInArrow(run, kept.schema)


@dataclass
class Top:
    """The contexts at the top of the tree that have too many places for one task.

    ``levels`` has those of 1, 2, ... words as sorted codes of (the suffix's number, first word).
    They are numbered from 1 through all levels, 0 is the empty one. ``suffix`` is each one's
    suffix, ``total`` its training count, ``rest`` what it leaves to its suffix; ``kept`` says whether
    it is retained.
    """

    width: int
    levels: list[np.ndarray] = field(default_factory=list)
    suffix: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    total: np.ndarray = field(default_factory=lambda: np.zeros(1))
    rest: np.ndarray = field(default_factory=lambda: np.ones(1))
    kept: np.ndarray = field(default_factory=lambda: np.zeros(1, bool))

    def add(self, codes: np.ndarray) -> None:
        self.levels.append(np.sort(codes))
        self.suffix = np.append(self.suffix, self.levels[-1] // self.width)

    def places(self, before: list[np.ndarray]) -> list[np.ndarray]:
        """For each length from 1, the number of the context of each place, 0 where it has none here."""
        found, first = [], 1
        for k, codes in enumerate(self.levels):
            code = before[k] if not found else found[-1] * self.width + before[k]
            spot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = (codes[spot] == code) & (before[k] >= 0)
            hit &= found[-1] > 0 if found else True
            found.append(np.where(hit, first + spot, 0))
            first += len(codes)
        return found

    def close(self) -> None:
        """Suffixes of what is retained are retained too, but for the empty one."""
        for own in range(len(self.suffix) - 1, 0, -1):
            self.kept[self.suffix[own]] |= self.kept[own]
        self.kept[0] = False


@dataclass
class Strings:
    """The places of all tokens, each with the string of words that ends there.

    ``before[k]`` is the word k + 1 places before the token, -1 where the text had not begun.
    ``last`` is the token itself and ``n`` its training count; ``train`` says whether the place is
    learnt from, ``owner`` which text it is in. ``hot[k]`` is the training count of the token
    behind its context of k + 1 words, if this is one of ``Top``.
    """

    before: list[np.ndarray]
    last: np.ndarray
    n: np.ndarray
    train: np.ndarray
    owner: np.ndarray
    hot: list[np.ndarray] = field(default_factory=list)

    def base(self, words: Vocabulary, top: Top, limits: TreeLimits) -> list[np.ndarray]:
        """Probability of each token after its contexts of 0, 1, ... words as far as ``Top`` has them."""
        found, low = [words.base(self.n)], limits.support(words.tokens)
        for context, n in zip(top.places(self.before), self.hot, strict=True):
            total = np.maximum(top.total[context], 1)
            longer = np.where(n >= low, (n - limits.discount) / total, 0) + top.rest[context] * found[-1]
            found.append(np.where(context > 0, longer, found[-1]))
        return found


def _read(piece: dict, depth: int) -> Strings:
    (codes,), (number, n) = _unpack(piece["codes"]), _unpack(piece["words"])
    real = codes != len(number) - 2
    owner = np.cumsum(~real) - 1
    train = ~np.array(piece["held_out"], bool)[owner]
    codes, n = number[codes], n[codes]
    at, before, open_ = np.flatnonzero(real), [], True
    for k in range(1, depth + 1):
        earlier = np.maximum(at - k, 0)
        before.append(np.where(open_, codes[earlier], -1))
        open_ = open_ & real[earlier]
    return Strings(before, codes[at], n[at], train[at], owner[at])


def _hot_strings(found: Strings, top: Top, parts: int) -> tuple[list, list, list[np.ndarray]]:
    """Different pairs of a context of ``Top`` and a token after it.

    For each level its places that have one, and their pairs; the (code, training places, count of
    the token) of each pair; and the pairs of each part, which the token alone decides.
    """
    places = [(some := np.flatnonzero(c), c[some]) for c in top.places(found.before)]
    rows = np.concatenate([np.zeros(0, np.int64), *(some for some, _ in places)])
    codes = np.concatenate([np.zeros(0, np.int64), *(c * top.width + found.last[s] for s, c in places)])
    pair, first = _groups(codes)
    n = np.bincount(pair[found.train[rows]], minlength=len(first))
    cuts = np.cumsum([len(some) for some, _ in places])[:-1]
    own = list(zip((some for some, _ in places), np.split(pair, cuts), strict=True)) if places else []
    codes = codes[first]
    return own, [codes, n, found.n[rows[first]]], _slices(codes % top.width, parts)


def _with_hot(piece: dict, top: Top, depth: int) -> Strings:
    """The places of a piece, with what ``top_table`` says of its strings."""
    found = _read(piece, depth)
    places, _, _ = _hot_strings(found, top, 1)
    for (some, pair), n in zip(places, _unpack(piece["hot"]) * len(places), strict=True):
        found.hot.append(np.zeros(len(found.last), np.int64))
        found.hot[-1][some] = n[pair]
    return found


def hot_contexts(pieces: DataFrame, top: Top, depth: int, parts: int) -> None:
    """Add the contexts of 2, 3, ... words with ``_PLACES`` places, as long as there are any."""

    def count(asked: pa.Table) -> pa.Table:
        codes, n = (np.concatenate(x) for x in zip(*map(_unpack, asked["data"].to_pylist()), strict=True))
        group, first = _groups(codes)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, group, n)
        return pa.table({"code": codes[first][total >= _PLACES]})

    for k in range(1, depth):

        def ask(batches: Iterator[pa.RecordBatch], k: int = k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in batch.to_pylist():
                    before = _read(piece, k + 1).before
                    context = top.places(before)[-1]
                    some = (context > 0) & (before[k] >= 0)
                    codes = context[some] * top.width + before[k][some]
                    group, first = _groups(codes)
                    codes, n = codes[first], np.bincount(group)
                    own = _slices(codes, parts)
                    full = [k for k in range(parts) if len(own[k])]
                    yield _asks(full, piece["piece"], [_pack(codes[own[k]], n[own[k]]) for k in full])

        asked = pieces.select("piece", "codes", "words", "held_out").mapInArrow(ask, _ASK)
        found = stored(asked.groupBy("part").applyInArrow(count, "code bigint"), "hot")
        codes = np.array([r.code for r in found.collect()], np.int64)
        if not len(codes):
            break
        top.add(codes)


def top_table(pieces: DataFrame, top: Top, parts: int) -> DataFrame:
    """For each piece and part, the training counts of its strings that end behind a context of ``Top``.

    A part has all strings that end in some words. Rows of no piece hold its different ones:
    context, training count, training count of the last word, and the place of the string without its
    first word, counted from 1.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                _, columns, own = _hot_strings(_read(piece, len(top.levels)), top, parts)
                full = [k for k in range(parts) if len(own[k])]
                yield _asks(full, piece["piece"], [_pack(*(c[own[k]] for c in columns)) for k in full])

    def count(asked: pa.Table) -> pa.Table:
        lists = [_unpack(x) for x in asked["data"].to_pylist()]
        codes, counts, single = (np.concatenate(x) for x in zip(*lists, strict=True))
        pair, first = _groups(codes)
        own, last, n = codes[first], single[first], np.zeros(len(first), np.int64)
        np.add.at(n, pair, counts)
        context, word = np.divmod(own, top.width)
        suffix = top.suffix[context]
        spot = np.where(suffix > 0, np.searchsorted(own, suffix * top.width + word) + 1, 0)
        cuts = np.cumsum([len(x[0]) for x in lists])[:-1]
        data = [_pack(n[p]) for p in np.split(pair, cuts)] + [_pack(context, n, last, spot)]
        part = asked["part"].to_pylist()
        columns = {"piece": pa.array([*asked["piece"].to_pylist(), None], pa.int64())}
        columns |= {"part": pa.array([*part, part[0]], pa.int32()), "data": pa.array(data, pa.binary())}
        return pa.table(columns)

    asked = pieces.select("piece", "codes", "words", "held_out").mapInArrow(ask, _ASK)
    return asked.groupBy("part").applyInArrow(count, _REPLY)


def with_top(pieces: DataFrame, table: DataFrame, top: Top, parts: int) -> DataFrame:
    """The pieces with the training counts of their strings that end behind a context of ``Top``."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (piece,) = left.select(["codes", "words", "held_out"]).to_pylist()
        _, (codes, *_), own = _hot_strings(_read(piece, len(top.levels)), top, parts)
        n = np.zeros(len(codes), np.int64)
        for part, data in zip(right["part"].to_pylist(), right["data"].to_pylist(), strict=True):
            (n[own[part]],) = _unpack(data)
        return left.append_column("hot", [[_pack(n)]])

    replies = table.where(F.col("piece").isNotNull())
    own = pieces.withColumn("hot", F.lit(None).cast("binary"))
    return pieces.groupBy("piece").cogroup(replies.groupBy("piece")).applyInArrow(run, own.schema)


def fit_top(table: DataFrame, top: Top, words: Vocabulary, limits: TreeLimits) -> None:
    """What each context of ``Top`` leaves to its suffix, and whether its own distribution diverges."""
    low, size = limits.support(words.tokens), len(top.suffix)

    def sums(of) -> np.ndarray:
        """Sums by context of the columns that ``of`` makes of the strings of a part."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(0).to_pylist():
                    context, *strings = _unpack(data)
                    some = np.unique(context)
                    found = [np.bincount(context, x, size)[some] for x in of(context, *strings)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some), *map(pa.array, found)], ["context", "a", "b", "c"]
                    )

        found = table.where(F.col("piece").isNull()).select("data")
        found = found.mapInArrow(run, "context bigint, a double, b double, c double")
        out = np.zeros((3, size))
        for row in found.groupBy("context").agg(*(F.sum(c) for c in "abc")).collect():
            out[:, row[0]] = row[1:]
        return out

    discount = limits.discount
    top.total, edges, counts = sums(lambda context, n, last, spot: (n, n >= low, np.where(n >= low, n, 0)))
    inner = edges > 0
    top.rest = np.ones(size)
    top.rest[inner] = 1 - (counts[inner] - discount * edges[inner]) / top.total[inner]
    total, rest, suffix, levels = np.maximum(top.total, 1), top.rest, top.suffix, len(top.levels)

    def nats(context, n, last, spot):
        shorter = words.base(last)
        own = np.where(n >= low, (n - discount) / total[context], 0)
        for _ in range(levels):  # suffixes first: after k rounds those of k words are right
            prob = own + rest[context] * shorter
            shorter = np.where(spot > 0, prob[spot - 1], words.base(last))
        often = n >= low
        return np.where(often, prob, 0), np.where(often, prob * np.log(prob / shorter), 0), often

    mass, gained, _ = sums(nats)
    gained += np.maximum(1 - mass, 0) * np.log(rest)
    top.kept = inner & (gained >= limits.divergence) & (gained * top.total >= limits.gain)
    top.close()


def grow_tree(
    strings: Strings, words: Vocabulary, top: Top, limits: TreeLimits
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Part of the tree: all its strings counted, their probabilities and the contexts retained.

    ``strings`` are all places, of all texts, whose shortest context outside ``Top`` is one of some
    contexts: no other part has these, nor any longer context that ends in one. Returns the
    probability of each token after its longest retained context, whether this has to be sought in
    ``Top``, and the contexts of ``Top`` that are suffixes of retained ones.
    """
    low, discount = limits.support(words.tokens), limits.discount
    size, places = len(strings.last), top.places(strings.before)
    parent = strings.base(words, top, limits)[-1]
    above = np.zeros(size, np.int64)  # the longest context in the top
    for context in places:
        above = np.where(context > 0, context, above)
    names, first = _groups(strings.last)
    width, tops = len(first), len(top.suffix)
    code, open_, levels = above.copy(), np.ones(size, bool), []
    single, unique = np.zeros(size, bool), np.zeros(size, bool)  # the place of its context, of its string
    for k, word in enumerate(strings.before):
        open_ &= word >= 0
        below = open_ & (places[k] == 0) if k < len(places) else open_
        some = np.flatnonzero(below)
        if not len(some):
            continue
        own, one = _groups_but(word[some], single[some])
        group, one = _groups_but(code[some] * len(one) + own, single[some])
        string, of = _groups_but(group * width + names[some], unique[some])
        single[some] = np.bincount(group)[group] == 1
        unique[some] = np.bincount(string)[string] == 1
        train, holder = strings.train[some], group[of]
        n = np.bincount(string[train], minlength=len(of))
        total = np.maximum(np.bincount(group[train], minlength=len(one)), 1)
        often = n >= low
        edges = np.bincount(holder[often], minlength=len(one))
        counts = np.bincount(holder[often], n[often], len(one))
        rest = np.where(edges > 0, 1 - (counts - discount * edges) / total, 1)
        shorter = parent[some[of]]
        prob = np.where(often, (n - discount) / total[holder], 0) + rest[holder] * shorter
        mass = np.bincount(holder[often], prob[often], len(one))
        nats = np.bincount(holder[often], (prob * np.log(prob / shorter))[often], len(one))
        nats = nats + np.maximum(1 - mass, 0) * np.log(rest)
        kept = (edges > 0) & (nats >= limits.divergence) & (nats * total >= limits.gain)
        parent = parent.copy()
        parent[some] = prob[string]
        levels.append((some, group, kept, parent))
        code[some] = tops + group
    value, sought = strings.base(words, top, limits)[-1], above > 0
    used = np.zeros(size, bool)
    for some, group, kept, prob in reversed(levels):
        kept = kept | (np.bincount(group[used[some]], minlength=len(kept)) > 0)
        hit = some[kept[group]]
        fresh = hit[~used[hit]]
        value[fresh], sought[fresh] = prob[fresh], False
        used[hit] = True
    return value, sought, np.unique(above[used & (above > 0)])


def _routes(strings: Strings, top: Top) -> np.ndarray:
    """The shortest context of each place that is outside ``Top``, -1 where there is none."""
    code, above = np.full(len(strings.last), -1), np.zeros(len(strings.last), np.int64)
    inside, places = np.ones(len(above), bool), top.places(strings.before)
    for k, word in enumerate(strings.before):
        context = places[k] if k < len(places) else np.zeros(len(above), np.int64)
        here = inside & (context == 0) & (word >= 0)
        code[here] = above[here] * top.width + word[here]
        inside &= context > 0
        above = np.where(context > 0, context, above)
    return code


def grown_table(
    pieces: DataFrame, words: Vocabulary, top: Top, limits: TreeLimits, parts: int
) -> DataFrame:
    """For each piece and part of the tree, the scores of its places by the contexts of the part.

    ``data`` has texts, their sums of log10 probabilities, and which places are left to ``Top``;
    ``marked`` the contexts of ``Top`` that are suffixes of retained ones.
    """
    depth = limits.depth

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                found = _with_hot(piece, top, depth)
                code = _routes(found, top)
                routed = np.flatnonzero(code >= 0)
                own = _slices(code[routed], parts)
                order = routed[np.concatenate(own)]
                columns = [c[order] for c in (*found.before, *found.hot, found.last, found.train)]
                owner, n = found.owner[order], found.n[order]
                part, data, end = [], [], 0
                for k in range(parts):
                    at, end = slice(end, end + len(own[k])), end + len(own[k])
                    if len(own[k]):
                        _, first = _groups(columns[-2][at])
                        counts = n[at][first]
                        part.append(k)
                        texts = np.diff(owner[at], prepend=0)
                        data.append(_pack(*(c[at] for c in columns), texts, counts))
                yield _asks(part, piece["piece"], data)

    def grow(asked: pa.Table) -> pa.Table:
        lists = [_unpack(x) for x in asked["data"].to_pylist()]
        cuts = np.cumsum([len(x[0]) for x in lists])[:-1]
        n = np.concatenate([x.pop()[_groups(x[-3])[0]] for x in lists])
        owners = [np.cumsum(x.pop()) for x in lists]
        *columns, last, train = (np.concatenate(x) for x in zip(*lists, strict=True))
        del lists
        owner = np.concatenate(owners)
        strings = Strings(columns[:depth], last, n, train.astype(bool), owner, columns[depth:])
        value, sought, marked = grow_tree(strings, words, top, limits)
        value = np.where(sought, 0, np.log10(value))
        data = []
        for own, score, left in zip(owners, np.split(value, cuts), np.split(sought, cuts), strict=True):
            text, first = _groups(own)
            texts = own[first]
            data.append(_pack(texts, np.bincount(text, score).view(np.int64), np.packbits(left)))
        marks = [marked.tolist(), *[None] * (len(data) - 1)]
        columns = {"piece": asked["piece"], "part": asked["part"], "data": pa.array(data, pa.binary())}
        return pa.table(columns | {"marked": pa.array(marks, pa.list_(pa.int64()))})

    asked = pieces.select("piece", "codes", "words", "held_out", "hot").mapInArrow(ask, _ASK)
    return asked.groupBy("part").applyInArrow(grow, f"{_REPLY}, marked array<bigint>")


def score_rows(
    pieces: DataFrame,
    grown: DataFrame,
    words: Vocabulary,
    top: Top,
    limits: TreeLimits,
    parts: int,
) -> DataFrame:
    """One row per text: what the parts of the tree say of its places, and ``Top`` of the others."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (piece,) = left.select(["codes", "words", "held_out", "hot"]).to_pylist()
        found = _with_hot(piece, top, limits.depth)
        size, code = left["doc_id"].combine_chunks().value_lengths()[0].as_py(), _routes(found, top)
        routed, score, sought = np.flatnonzero(code >= 0), np.zeros(size), code < 0
        own = _slices(code[routed], parts)
        for part, data in zip(right["part"].to_pylist(), right["data"].to_pylist(), strict=True):
            texts, sums, left_over = _unpack(data)
            score[texts] += sums.view(np.float64)
            at = routed[own[part]]
            sought[at] = np.unpackbits(left_over.astype(np.uint8), count=len(at)).astype(bool)
        probs = found.base(words, top, limits)
        value = probs[0]
        for context, prob in zip(top.places(found.before), probs[1:], strict=True):
            value = np.where(top.kept[context], prob, value)
        per_text = lambda some, x=None: np.bincount(found.owner[some], x, size)
        score += per_text(sought, np.log10(value[sought]))
        every = np.ones(len(code), bool)
        return pa.table(
            {
                "doc_id": left["doc_id"].combine_chunks().flatten(),
                "held_out": left["held_out"].combine_chunks().flatten(),
                "n_tokens": per_text(every),
                "n_known": per_text(found.n > 0),
                "train_tokens": pa.array([words.tokens] * size, pa.int64()),
                "base_score": per_text(every, np.log10(probs[0])),
                "score": score,
            }
        )

    kind = pieces.schema["doc_id"].dataType.elementType.simpleString()
    replies = grown.select("piece", "part", "data")
    return pieces.groupBy("piece").cogroup(replies.groupBy("piece")).applyInArrow(
        run,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


def language_scores(
    docs: DataFrame, limits: TreeLimits | None = None, held_part: int = 2, parts: int = 7
) -> DataFrame:
    """log10 probability of every text: ``base_score`` by single words, ``score`` by the tree.

    Both learn from the rows whose checksum of ``doc_id`` modulo ``parts`` is not ``held_part``.
    Tokens are the words and one end per text. The base adds one to every count. The tree takes
    the longest retained context before a token; what its counts leave over goes to the next shorter
    one, and finally to the base. It holds all words and all strings of the training texts: counts
    are exact however rare they are. The strings are dealt to tasks by their shortest context that
    has fewer than ``_PLACES`` places; the few that have more form the ``Top`` of the tree.

    Null and empty texts have the end as their only token. A null id counts as an empty one.
    Repeated rows count again and get a row each. Very long texts are read as a piece of their own.
    An empty table gives no rows; without training rows every token is unknown. Extra columns are
    not read. Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    limits = limits or TreeLimits()
    reach_workers(docs.sparkSession)
    read = stored(token_pieces(_rows(docs, held_part, parts)), "pieces")
    size = read.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "train", "texts"))).first()
    dealt = max(1, -(-size.tokens // _PLACES))
    table = stored(word_table(read, dealt), "vocabulary")
    pieces = stored(numbered_pieces(read, table, dealt, size.train), "numbered")
    sums = (F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "distinct"))
    tokens, distinct, last = table.agg(*sums, F.coalesce(F.max("top"), F.lit(_FIRST))).first()
    words = Vocabulary(tokens + size.train, distinct + (size.train > 0), last + 1)
    top = Top(words.width)
    hot = [r[0] for r in table.select(F.explode("hot")).collect()]
    hot += [_BEGIN] * (size.texts >= _PLACES)
    discard(read)
    discard(table)
    if hot:
        top.add(np.array(hot, np.int64))
        hot_contexts(pieces, top, limits.depth, dealt)
        counts = stored(top_table(pieces, top, dealt), "top")
        fit_top(counts, top, words, limits)
        bare, pieces = pieces, stored(with_top(pieces, counts, top, dealt), "pieces")
        discard(bare)
        discard(counts)
    else:
        pieces = pieces.withColumn("hot", F.lit(_pack()))
    grown = stored(grown_table(pieces, words, top, limits, dealt), "grown")
    for (context,) in grown.select(F.explode("marked")).distinct().collect():
        top.kept[context] = True
    top.close()
    return score_rows(pieces, grown, words, top, limits, dealt)
