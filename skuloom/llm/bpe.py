"""Byte-level BPE: speculative encoding, decoding, and exact token counts of every prefix.

The split into words is the vocabulary's own pattern; merges, proposals and counts are made here.
A token sequence is the encoding of its bytes exactly when every adjacent pair is the encoding of
the pair's own bytes, so one check per pair verifies a guess, and a prefix has exactly one last token.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import reach_workers, text_of

#: Pattern that splits text into words (fixed value of the vocabulary's byte-level splitter).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered per worker; beyond that the memory starts afresh, results do not change.
REMEMBERED = 600_000
#: Longer words are counted all the same, but not remembered.
_LONG_WORD = 200
_NEVER = np.int64(1) << 40


def _shown_bytes() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shown = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return shown | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special strings of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, shown = content["model"], _shown_bytes()
        self.id_of = {bytes(shown[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"] if t["special"]}
        for text in self.special:
            self.id_of.pop(text.encode(), None)
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of = [b""] * size
        for piece, i in self.id_of.items():
            self.bytes_of[i] = piece
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.decimal = [str(i) for i in range(size)]
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        # made: merge that makes a token, -1 for bytes; left and right: what it is made of
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        names = {t: i for t, i in model["vocab"].items()}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            token = names[a + b]
            self.merge[names[a], names[b]] = rank, token
            if self.made[token] < 0:
                self.made[token], self.left[token], self.right[token] = rank, names[a], names[b]
        keys = np.array([a << 32 | b for a, b in self.merge], np.int64)
        ranks = np.array([r for r, _ in self.merge.values()], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.made_list, self.left_list, self.right_list = (
            x.tolist() for x in (self.made, self.left, self.right)
        )
        self.longest: dict[bytes, int] = {}
        for piece in self.id_of:
            head = piece[:2]
            self.longest[head] = max(self.longest.get(head, 0), len(piece))
        self.splitter = regex.compile(PATTERN)
        self.special_split = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self._ids: dict[str, bytes] = {}
        self._counts: dict[str, bytes | list[int]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._endings: ahocorasick.Automaton | None = None

    # ---- words -------------------------------------------------------------------------------

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """Text between special strings, and the special strings with their ids."""
        if self.special_split is None or not any(s in text for s in self.special):
            return [(text, None)]
        return [(s, self.special.get(s)) for s in self.special_split.split(text) if s]

    # ---- exact merging -----------------------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """Encoding by the merges themselves: lowest rank first, leftmost first."""
        token = [self.single[b] for b in word]
        after = list(range(1, len(token) + 1))
        before = list(range(-1, len(token) - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(token) and (found := self.merge.get((token[i], token[j]))):
                heapq.heappush(heap, (found[0], i, token[i], token[j], found[1]))

        for i in range(len(token) - 1):
            offer(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if token[i] != a or j >= len(token) or token[j] != b:
                continue
            token[i], token[j] = made, -1
            after[i] = after[j]
            if after[i] < len(token):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t in token if t >= 0]

    # ---- compatibility of neighbours ---------------------------------------------------------

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is the encoding of its own bytes, for all pairs at once.

        The merges that made the two tokens are undone from the latest to the earliest. At each
        moment the tokens on both sides of the border must not merge before either is used up:
        a merge of the same rank happens first on the left.
        """
        good = np.ones(len(first), bool)
        at = np.arange(len(first))
        x, y = first.astype(np.int64), second.astype(np.int64)
        x_used, y_used = np.full(len(x), _NEVER), np.full(len(y), _NEVER)
        while len(at):
            key = x << 32 | y
            spot = np.searchsorted(self.pair_keys, key)
            spot[spot == len(self.pair_keys)] = 0
            rank = np.where(self.pair_keys[spot] == key, self.pair_ranks[spot], _NEVER)
            crossed = (rank < x_used) & (rank <= y_used) & (rank < _NEVER)
            good[at[crossed]] = False
            made_x, made_y = self.made[x], self.made[y]
            go = ~crossed & ((made_x >= 0) | (made_y >= 0))
            at, x, y = at[go], x[go], y[go]
            x_used, y_used, made_x, made_y = x_used[go], y_used[go], made_x[go], made_y[go]
            undo_x = made_x > made_y
            x_used, y_used = np.where(undo_x, made_x, x_used), np.where(undo_x, y_used, made_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def fits(self, x: int, y: int) -> bool:
        """``compatible`` for one pair, remembered."""
        known = self._fits.get((x, y))
        if known is not None:
            return known
        pair, x_used, y_used, result = (x, y), _NEVER, _NEVER, True
        made, merge = self.made_list, self.merge
        while True:
            found = merge.get((x, y))
            if found and found[0] < x_used and found[0] <= y_used:
                result = False
                break
            made_x, made_y = made[x], made[y]
            if made_x < 0 and made_y < 0:
                break
            if made_x > made_y:
                x, x_used = self.right_list[x], made_x
            else:
                y, y_used = self.left_list[y], made_y
        if len(self._fits) >= 2 * REMEMBERED:
            self._fits.clear()
        self._fits[pair] = result
        return result

    # ---- speculate and verify ----------------------------------------------------------------

    def guess(self, word: bytes) -> list[int]:
        """The longest token at each place, from left to right."""
        if (whole := self.id_of.get(word)) is not None:
            return [whole]
        out, at, end, id_of, longest = [], 0, len(word), self.id_of, self.longest
        while at < end:
            stop = min(end, at + longest.get(word[at : at + 2], 1))
            while stop > at + 1 and word[at:stop] not in id_of:
                stop -= 1
            out.append(id_of[word[at:stop]])
            at = stop
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word: proposals, one check of all adjacent pairs, merging where one fails."""
        raw = [w.encode() for w in words]
        proposed = [self.guess(w) for w in raw]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        if len(flat) < 2:
            return proposed
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        for k in np.unique(owner[inner[~good[which]]]).tolist():
            proposed[k] = self.merged(raw[k])
        return proposed

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; new words of a stretch of texts are encoded together."""
        ids = self._ids
        for stretch in self._stretches(texts):
            words = set()
            for parts in stretch:
                for own, _ in parts:
                    words.update(own)
            new = words.difference(ids)
            if len(ids) + len(new) > REMEMBERED:
                ids.clear()
                new = words
            listed = list(new)
            for word, encoded in zip(listed, self.encode_words(listed), strict=True):
                ids[word] = np.array(encoded, "<u4").tobytes()
            for parts in stretch:
                raw = b"".join(
                    b"".join(map(ids.__getitem__, own))
                    if special is None
                    else np.array([special], "<u4").tobytes()
                    for own, special in parts
                )
                yield np.frombuffer(raw, "<u4")

    def _stretches(self, texts: list[str], chars: int = 1_000_000):
        """Consecutive texts of together about ``chars`` characters, split into words."""
        stretch, held = [], 0
        for text in texts:
            stretch.append(
                [
                    (self.splitter.findall(part) if special is None else [], special)
                    for part, special in self.segments(text)
                ]
            )
            held += len(text)
            if held >= chars:
                yield stretch
                stretch, held = [], 0
        if stretch:
            yield stretch

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids, special ones included; broken UTF-8 gives replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    # ---- counts of all prefixes --------------------------------------------------------------

    @property
    def endings(self) -> ahocorasick.Automaton:
        """Finds the tokens that end at each byte, the longest first; bytes stand as characters."""
        if self._endings is None:
            found = ahocorasick.Automaton()
            for piece, token in self.id_of.items():
                found.add_word(piece.decode("latin-1"), (token, len(piece)))
            found.make_automaton()
            self._endings = found
        return self._endings

    def byte_counts(self, word: str) -> bytes | list[int]:
        """Tokens of every byte prefix of one word, from the empty one on.

        The last token of a prefix is the only one, among those ending there, that is compatible
        with the last token of the prefix before it; its count is one more than that prefix's.
        """
        known = self._counts.get(word)
        if known is not None:
            return known
        raw = word.encode()
        n, fits = len(raw), self._fits
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for stop, (token, size) in self.endings.iter(raw.decode("latin-1")):
            stop += 1
            if count[stop]:
                continue
            if at := stop - size:
                before = last[at]
                good = fits.get((before, token))
                if not (self.fits(before, token) if good is None else good):
                    continue
            last[stop], count[stop] = token, count[at] + 1
        result = bytes(count) if n < 256 else count
        if n <= _LONG_WORD:
            if len(self._counts) >= REMEMBERED:
                self._counts.clear()
            self._counts[word] = result
        return result

    def count(self, text: str) -> int:
        """Tokens of a text: the last entries of its words' prefix counts."""
        total, known = 0, self._counts
        for segment, special in self.segments(text):
            if special is not None:
                total += 1
                continue
            for word in self.splitter.findall(segment):
                counts = known.get(word)
                total += (self.byte_counts(word) if counts is None else counts)[-1]
        return total

    def _char_counts(self, word: str) -> np.ndarray:
        """Tokens of the prefixes of 1, 2, ... characters of a word."""
        counts = np.array(list(self.byte_counts(word)), np.int64)
        ends = np.cumsum([len(c.encode()) for c in word])
        out = counts[ends]
        if word in ("'re", "'ve", "'ll"):  # cut short, it is a sign and a letter
            out[1] = 2
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of each prefix of 0, 1, ... characters, each as if it were the whole text."""
        out, base, tail = [np.zeros(1, np.int64)], 0, ""
        for segment, special in self.segments(text):
            if special is not None:
                before = base - sum(self.byte_counts(w)[-1] for w in self.splitter.findall(tail))
                cuts = [tail + segment[:k] for k in range(1, len(segment))]
                out.append(np.array([before + self.count(c) for c in cuts] + [base + 1], np.int64))
                base, tail = base + 1, ""
                continue
            found = [(m.start(), m.group()) for m in self.splitter.finditer(segment)]
            counts, at = np.zeros(len(segment), np.int64), base
            starts = {}
            for start, word in found:
                own = self._char_counts(word)
                starts[start] = at
                counts[start : start + len(word)] = own + at
                at += int(own[-1])
            # blanks at the end of a prefix form one word, whatever follows them in the text
            for run in regex.finditer(r"\s+", segment):
                counts[run.start() : run.end()] = (
                    starts[run.start()] + self._char_counts(run.group())
                )
            out.append(counts)
            base, tail = at, segment[found[-1][0] :] if found else ""
        return np.concatenate(out)

    def longest_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.

        Counts before whole words only grow, so the end lies near the word that passes the budget;
        only the prefixes around it are looked up.
        """
        at, base, seen = 0, 0, []
        for segment, special in self.segments(text):
            found = (m.group() for m in self.splitter.finditer(segment))
            for word in found if special is None else [segment]:
                seen.append((at, base))
                at += len(word)
                base += 1 if special is not None else self.byte_counts(word)[-1]
                if base > budget:
                    break
            if base > budget:
                break
        else:
            return len(text)
        k = max(0, len(seen) - 3)
        while k and text[seen[k][0] - 1].isspace():
            k -= 1
        start, before = seen[k]
        # a run of blanks is two words at most; a special string may follow
        stop = at + sum(len(w) for w in self.splitter.findall(text[at : at + 4096])[:2])
        counts = before + self.prefix_counts(text[start:stop])
        return start + int(np.flatnonzero(counts <= budget)[-1])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker and file; its memory of words lives as long as the worker."""
    return Vocabulary(path)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"], text_of(docs).alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Ids of every text as an array: doc_id, text, ids. Null text: no ids. Rows stay as they are."""
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [x.tolist() for x in words.encode(texts)]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, kind)], ["doc_id", "text", "ids"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(run, f"doc_id {kind}, text string, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them.

    Null counts as empty: no tokens and the digests of nothing. Repeated rows and null ids give a
    row each. Texts of any length are taken whole, one after the other.
    """
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            n, ids_digest, text_digest = [], [], []
            for ids in words.encode(batch.column(1).to_pylist()):
                listed = ids.tolist()
                n.append(len(listed))
                shown = ",".join(map(words.decimal.__getitem__, listed))
                ids_digest.append(hashlib.sha256(shown.encode()).hexdigest())
                decoded = words.decode(listed)
                text_digest.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(ids_digest, pa.string()),
                    pa.array(text_digest, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Exact tokens of every text, and how many of its characters fit into ``limit`` tokens.

    Null counts as empty (0 bytes, 0 tokens). Repeated rows and null ids give a row each.
    """
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = [words.count(t) for t in texts]
            fit = [
                len(t) if k <= limit else words.longest_prefix(t, limit)
                for t, k in zip(texts, n, strict=True)
            ]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, n, fit))],
                ["doc_id", "n_bytes", "n_tokens", "fit_chars"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = _rows(docs).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, fit_chars bigint"
    )
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > F.lit(limit)).alias("over_limit"),
        "fit_chars",
    )


def prefix_token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``counts``: tokens of each prefix of 0, 1, ... characters of the text.

    Any truncation or budget question is a lookup in that array. Null counts as empty: [0].
    """
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for k, text in enumerate(batch.column(1).to_pylist()):
                counts = pa.array([words.prefix_counts(text).tolist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), counts], ["doc_id", "counts"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(run, f"doc_id {kind}, counts array<int>")
