"""Quality rules: per-document counts and lines that too many documents of a host share."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import (
    BLANKS,
    by_position,
    digest,
    fresh,
    quoted,
    reach_workers,
    salted_join,
    stored,
    text_of,
)

#: Up to this many frequent lines (24 bytes each) are sent to every executor; beyond, they are joined.
BROADCAST_LINES = 200_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = re.compile(BLANKS)
_SYMBOLS = re.compile(r"[#*$%&|<>]+")
_WINDOW = 8


@dataclass(frozen=True)
class LineLimits:
    """When a line is boilerplate, and when a document has too little left without such lines.

    A line goes when more than ``most`` documents of its host have it, or more than ``share`` of them
    and more than ``least``. Copies of one text, blanks apart, are one document, in the counts of lines
    and of the host alike: a text alone never makes its own lines frequent.
    A document is depleted when fewer than ``words_left`` words stay, or less than ``part_left`` of
    its words.
    """

    share: float = 0.1
    least: int = 3
    words_left: int = 20
    part_left: float = 0.2
    most: int = 50


def line_key(line: str) -> bytes | None:
    """16-byte hash of a line without regard to case, digits and blanks; None if it has no word."""
    words = _WORD.findall(line)
    if not words:
        return None
    plain = re.sub(r"\d", "0", " ".join(words).casefold())
    return hashlib.blake2b(plain.encode(), digest_size=16).digest()


def repeated_words(words: list[str]) -> int:
    """Words inside those windows of eight words that occur twice or more, first ones included.

    Windows are named by doubling: pairs of names of 1, 2, 4 words become names of 2, 4, 8.
    """
    n = len(words)
    if n <= _WINDOW:
        return 0
    first: dict[str, int] = {}
    names = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, n)
    if len(first) == n:
        return 0
    for width in (1, 2, 4):
        pairs = names[:-width] * np.int64(n + 1) + names[width:]
        _, names = np.unique(pairs, return_inverse=True)
    again = np.bincount(names)[names] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[: len(again)] += again
    edges[_WINDOW : _WINDOW + len(again)] -= again
    return int((np.cumsum(edges)[:n] > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = _WORD.findall(text)
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif _WORD.search(line):
            seen.add(line)
    symbols = sum(map(len, _SYMBOLS.findall(text)))
    return len(words), sum(map(len, words)), symbols, again, repeated_words(words)


def frequent_lines(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, line) above the limits: lines counted by documents of a host that have them."""
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, lines, documents = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                own = {line_key(line) for line in text.split("\n")} - {None}
                plain = _BLANKS.sub(" ", text)
                name = hashlib.blake2b(plain.encode(), digest_size=16).digest()
                owner += [k] * (len(own) + 1)
                lines += [b"", *own]  # the empty key counts the host's documents
                documents += [name] * (len(own) + 1)
            host = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [host, pa.array(lines, pa.binary()), pa.array(documents, pa.binary())],
                ["host", "line", "document"],
            )

    host = F.coalesce(docs["source"].cast("string"), F.lit("")).alias("host")
    found = docs.select(host, text_of(docs)).mapInArrow(
        run, "host string, line binary, document binary"
    )
    counts = found.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("documents"))
    counts = counts.where(F.col("documents") > min(limits.least, limits.most))
    counts = stored(counts, "lines")
    hosts = counts.where("line = X''").select("host", F.col("documents").alias("total"))
    n = F.col("documents")
    shared = (n > limits.least) & (n > F.lit(limits.share) * F.col("total"))
    return (
        counts.where("line <> X''")
        .join(hosts, "host")
        .where((n > limits.most) | shared)
        .select("host", "line")
    )


def _with_hits(docs: DataFrame, limits: LineLimits) -> tuple[DataFrame, str, str, Broadcast]:
    """docs with their host and, when the frequent lines are too many to send, their own hits."""
    lines = stored(frequent_lines(docs, limits), "frequent-lines")
    host, hits = fresh(docs, "_host"), fresh(docs, "_hits")
    docs = docs.withColumn(host, F.coalesce(docs["source"].cast("string"), F.lit("")))
    if lines.count() <= BROADCAST_LINES:
        sent = {(r["host"], bytes(r["line"])) for r in lines.collect()}
        docs = docs.withColumn(hits, F.lit(None).cast("array<binary>"))
        return docs, host, hits, docs.sparkSession.sparkContext.broadcast(sent)
    name = fresh(docs, "_name")
    docs = docs.withColumn(name, digest(text_of(docs)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                list({line_key(line) for line in text.split("\n")} - {None})
                for text in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.binary()))],
                ["host", "name", "lines"],
            )

    texts = docs.select(F.col(host).alias("host"), F.col(name).alias("name"), text_of(docs))
    own = texts.mapInArrow(keys, "host string, name string, lines array<binary>")
    own = own.select("host", "name", F.explode("lines").alias("line")).distinct()
    # a text's own lines fit into one task as the text itself does
    hit = (
        salted_join(own, lines, ["host", "line"], "inner")
        .groupBy(F.col("host").alias(host), F.col("name").alias(name))
        .agg(F.collect_list("line").alias(hits))
    )
    docs = salted_join(docs, stored(hit, "hits"), [host, name], "left")
    return docs, host, hits, docs.sparkSession.sparkContext.broadcast(None)


def _split(text: str, host: str, own: list[bytes] | None, sent: set | None) -> list[str]:
    """The lines that stay."""
    if sent is None:
        gone = set(own or ())
        return [x for x in text.split("\n") if not gone or line_key(x) not in gone]
    return [x for x in text.split("\n") if (host, line_key(x)) not in sent]


def _depleted(n_words: int, left: int, limits: LineLimits) -> bool:
    return left < n_words and (left < limits.words_left or left < limits.part_left * n_words)


def quality_verdicts(docs: DataFrame, limits: LineLimits | None = None) -> DataFrame:
    """Counts of every document, whether the base rules fail it, and whether it stays.

    ``source`` is the host; null hosts are one host. Null texts have no words and fail. Columns:
    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, and
    n_words_left after the removal of frequent lines. Repeated rows and null ids give a row each.
    """
    limits = limits or LineLimits()
    found, host, hits, sent = _with_hits(docs, limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
        for batch in batches:
            counts, failed, kept, left = [], [], [], []
            columns = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for text, own_host, own in zip(*columns, strict=True):
                row = base_counts(text)
                words, repeats = row[0], row[4]
                stay = _split(text, own_host, own, sent.value)
                rest = words if len(stay) == text.count("\n") + 1 else sum(
                    len(_WORD.findall(line)) for line in stay
                )
                counts.append(row)
                failed.append(words < 20 or 100 * repeats > 30 * words)
                kept.append(not failed[-1] and not _depleted(words, rest, limits))
                left.append(rest)
            table = np.array(counts, np.int64).reshape(-1, len(names))
            arrays = [pa.array(column) for column in table.T.copy()]
            verdicts = [
                pa.array(failed, pa.bool_()),
                pa.array(kept, pa.bool_()),
                pa.array(left, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays, *verdicts],
                ["doc_id", *names, "base_failed", "kept", "n_words_left"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = found.select(found["doc_id"], text_of(found), found[host], found[hits])
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, n_words_left bigint",
    )


def clean_documents(docs: DataFrame, limits: LineLimits | None = None) -> DataFrame:
    """The documents that stay, with all their columns and without the frequent lines.

    ``n_chars``, where there is one, is counted anew for texts that lost lines. Texts that lose
    nothing are passed on as they are. Null and empty texts have no words and go; an empty table
    gives no rows; repeated rows and copies are judged alike, so all of them stay or go; long texts
    are judged whole.
    """
    limits = limits or LineLimits()
    found, host, hits, sent = _with_hits(docs, limits)
    at, names = {c: i for i, c in enumerate(found.columns)}, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            columns = (batch.column(at[c]).to_pylist() for c in ("text", host, hits))
            for k, (text, own_host, own) in enumerate(zip(*columns, strict=True)):
                text = text or ""
                words, *_, repeats = base_counts(text)
                if words < 20 or 100 * repeats > 30 * words:
                    continue
                stay = _split(text, own_host, own, sent.value)
                if len(stay) < text.count("\n") + 1:
                    rest = sum(len(_WORD.findall(line)) for line in stay)
                    if _depleted(words, rest, limits):
                        continue
                    text = "\n".join(stay)
                rows.append(k)
                texts.append(text)
            taken = batch.take(pa.array(rows, pa.int64()))
            arrays = {c: taken.column(at[c]) for c in names}
            arrays["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    cleaned = by_position(found).mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.char_length("text").cast(kind)).select(quoted(docs))
