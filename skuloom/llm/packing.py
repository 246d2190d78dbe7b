"""Packing of token sequences by the histogram of their lengths."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.bpe import PATTERN, Vocabulary
from skuloom.llm.common import in_runs, reach_workers, running_starts, stored, text_of

#: Id that ends every document.
END = 1
#: Parts in which the pieces of one length are numbered.
BLOCKS = 512
#: Blanks in a row from which a text goes to the tokenizers library: the compiled encoder's pattern
#: runs out of stack at about a million.
LONG_BLANKS = 200_000
#: What makes two pieces the same; also the order of their ranks.
_PIECE_KEY = ["length", "doc_id", "doc_tokens", "start", "ids_crc32"]


@lru_cache(maxsize=2)
def _encoder(path: str):
    """The vocabulary's merges in a compiled encoder; special strings count as special tokens."""
    import tiktoken

    words = Vocabulary(path)
    ranks = {piece: i for i, piece in enumerate(words.bytes_of) if i not in words.special.values()}
    return tiktoken.Encoding(
        path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=words.special
    )


@lru_cache(maxsize=2)
def _library(path: str):
    """The same vocabulary in the tokenizers library: slower, but without a limit on blanks."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoded(text: str, path: str) -> np.ndarray:
    """Ids of any text."""
    if len(text) >= LONG_BLANKS and any(
        m.end() - m.start() >= LONG_BLANKS for m in re.finditer(r"\s+", text)
    ):
        return np.array(_library(path).encode(text, add_special_tokens=False).ids, np.uint32)
    return _encoder(path).encode_to_numpy(text, allowed_special="all")


def pieces(docs: DataFrame, path: str, size: int) -> DataFrame:
    """Each document's ids and the final id, cut into full sequences and a remainder.

    One row per piece: doc_id, start, length, ids_crc32 (over little-endian 32-bit ids) and the
    document's tokens. Null and empty texts have the final id only.
    """
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, crc, tokens = [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = encoded(text, path)
                raw = np.append(ids, END).astype("<u4").tobytes()
                n = len(ids) + 1
                for at in range(0, n, size):
                    part = raw[4 * at : 4 * (at + size)]
                    row.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens)),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], text_of(docs)).mapInArrow(
        run,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint",
    )


def pack_patterns(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, by shortest-pack-first.

    Lengths are placed from the longest to the shortest. All pieces of one length go to the packs
    with the most room left, as far as they fit; a pattern is split when only some of its packs
    get one. What is left over opens new packs, as many pieces to a pack as it can hold.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], times: int, room: int) -> None:
        if room == 0:
            done.append((pattern, times))
        else:
            open_packs.setdefault(room, []).append((pattern, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = max(open_packs, default=0)
            if room < length:
                break
            pattern, times = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            used = min(left, times)
            put((*pattern, length), used, room - length)
            if times > used:
                put(pattern, times - used, room)
            left -= used
        each = size // length
        if left >= each:
            put((length,) * each, left // each, size - each * length)
        if left % each:
            put((length,) * (left % each), 1, size - left % each * length)
    return done + [pack for packs in open_packs.values() for pack in packs]


def _places(patterns: list[tuple[tuple[int, ...], int]], first: int) -> dict[str, np.ndarray]:
    """For each length, stretches of ranks and the sequences and offsets they go to."""
    rows, next_rank, sequence = [], {}, first
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, offset))
            next_rank[length] = rank + times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {n: table[:, i] for i, n in enumerate(("length", "rank", "sequence", "offset"))}


def pack_documents(docs: DataFrame, path: str, size: int = 2048) -> DataFrame:
    """Where each piece of each document goes: sequence and offset, with little padding.

    Documents are cut into full sequences, which need no partner, and a remainder; remainders are
    packed by the histogram of their lengths (at most ``size`` counts reach the driver), and the
    patterns, at most a few per length, go back to the pieces by their rank among pieces of
    equal length. Ranks are counted block by block, so one very common length fills no task.
    Null ids and repeated rows are documents of their own; equal rows are counted, ranked in runs of
    10,000 that lie in blocks of their own, and laid out again run by run. Extra columns are not read.
    Sequence ids run gaplessly from 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    counted = (
        pieces(docs, path, size)
        .groupBy("doc_id", "start", "length", "ids_crc32", "doc_tokens")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    rows = stored(in_runs(counted, "copies", "run"), "pieces")
    histogram = {
        r["length"]: r["n"]
        for r in rows.groupBy("length").agg(F.sum("copies").alias("n")).collect()
    }
    full = histogram.pop(size, 0)
    places = spark.sparkContext.broadcast(_places(pack_patterns(histogram, size), full))
    keyed = rows.withColumn("block", F.pmod(F.xxhash64(*_PIECE_KEY, "run"), F.lit(BLOCKS)).cast("int"))
    ranked = running_starts(keyed, ["length"], "block", [*_PIECE_KEY, "run"], "copies", "rank_start")
    rank = F.explode(F.sequence(F.col("rank_start"), F.col("rank_start") + F.col("copies") - 1))
    ranked = ranked.select(*_PIECE_KEY, rank.alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        key = table["length"] << 44 | table["rank"]
        for batch in batches:
            length, at = batch.column(0).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = at.copy(), np.zeros(len(at), np.int64)
            rest = length < size
            spot = np.searchsorted(key, length[rest] << 44 | at[rest], side="right") - 1
            sequence[rest] = table["sequence"][spot] + at[rest] - table["rank"][spot]
            offset[rest] = table["offset"][spot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                [*_PIECE_KEY, "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = ranked.mapInArrow(
        run,
        f"length bigint, doc_id {kind}, doc_tokens bigint, start bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
