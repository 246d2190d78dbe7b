"""Removal of repeated byte strings by prefix doubling on sparse positions.

Two equal strings of LENGTH bytes have the same smallest 48-byte piece at the same place, their
anchor. So only anchors are ranked at first (names of 1, 2, 4, ... bytes by doubling, equal
names brought together by Spark). Starts whose anchor is unique drop out; the others are ranked
again at the full span that shares the anchor, and only what is still undecided, one by one, at
LENGTH bytes. The name of a class is its earliest position in the order of documents.

This replaces rounds in which Spark sorts a rank pair of every byte position at offsets 1, 2, 4, ...:
such rounds shuffle at least 16 bytes per byte of text each, beyond the disk that is allowed, while
here one anchor stands for dozens of positions and the doubling itself runs inside the tasks. Classes are
told apart by 64-bit names (two of them for single strings), not by comparing bytes again.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import (
    by_position,
    discard,
    fresh,
    quoted,
    reach_workers,
    running_starts,
    stored,
    text_of,
)

LENGTH = 100
_ANCHOR = 48
#: Bytes handled at once; small enough for a processor's cache.
_STRETCH = 1 << 18
#: Rows of an Arrow batch that a task works on at a time.
_ROWS = 500
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPLIT = np.uint64(0xBF58476D1CE4E5B9)
#: One value per byte and lane.
_LANES = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), np.uint64)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    x = left * _ODD + right
    x ^= x >> np.uint64(31)
    x *= _SPLIT
    x ^= x >> np.uint64(29)
    return x


def names(raw: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """A 64-bit name of the ``width`` bytes at each position, by doubling."""
    power, size = _LANES[lane][raw], 1
    whole, have = None, 0
    while True:
        if width & size:
            if whole is None:
                whole, have = power, size
            else:
                n = len(raw) - have - size + 1
                whole, have = _pair(whole[:n], power[have : have + n]), have + size
        if 2 * size > width:
            return whole
        power = _pair(power[: len(power) - size], power[size:])
        size *= 2


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` neighbours from each position on."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def units(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of each run of strings with one anchor, and the anchor's name."""
    first, last, anchors = [], [], []
    low = np.uint64((1 << 24) - 1)
    for begin in range(0, len(raw) - length + 1, _STRETCH):
        part = raw[begin : begin + _STRETCH + length - 1]
        name = names(part, _ANCHOR)
        keyed = (name & ~low) | np.arange(len(name), dtype=np.uint64)
        at = (_least(keyed, length - _ANCHOR + 1) & low).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        first.append(begin + new)
        last.append(begin + np.concatenate([new[1:], [len(at)]]) - 1)
        anchors.append(name[at[new]])
    if not first:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(first), np.concatenate(last), np.concatenate(anchors).view(np.int64)


def _grouped(sizes: list[int]) -> Iterator[range]:
    """Consecutive texts of together about _STRETCH bytes."""
    begin, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > _STRETCH:
            yield range(begin, k)
            begin, held = k, 0
        held += size
    if begin < len(sizes):
        yield range(begin, len(sizes))


def units_of(raws: list[np.ndarray], length: int) -> tuple[np.ndarray, ...]:
    """Text number, first and last start, anchor of all units of many texts, in order."""
    found = []
    for group in _grouped([len(raw) for raw in raws]):
        if len(group) == 1 or sum(len(raws[k]) for k in group) < length:
            for k in group:
                lo, hi, anchor = units(raws[k], length)
                found.append((np.full(len(lo), k), lo, hi, anchor))
            continue
        sizes = np.array([len(raws[k]) for k in group])
        begin = np.cumsum(sizes) - sizes
        joined = np.concatenate([raws[k] for k in group])
        low = np.uint64((1 << 24) - 1)
        name = names(joined, _ANCHOR)
        keyed = (name & ~low) | np.arange(len(name), dtype=np.uint64)
        at = (_least(keyed, length - _ANCHOR + 1) & low).astype(np.int64)
        owner = np.repeat(np.arange(len(group)), sizes)[: len(at)]
        start = np.flatnonzero(np.arange(len(at)) + length <= (begin + sizes)[owner])
        at, owner = at[start], owner[start]
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        old = np.ones(len(start), bool)
        old[:-1] = new[1:]
        text = owner[new]
        found.append(
            (
                text + group.start,
                start[new] - begin[text],
                start[old] - begin[text],
                name[at[new]].view(np.int64),
            )
        )
    return tuple(np.concatenate([f[i] for f in found]) for i in range(4))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``_ROWS`` rows, so that what is derived from one stays small.

    Memory that a slice leaves in Arrow's pool goes back before the worker waits for its next task.
    """
    for batch in batches:
        for begin in range(0, batch.num_rows, _ROWS):
            yield batch.slice(begin, _ROWS)
    pa.default_memory_pool().release_unused()


def _read(df: DataFrame, each: Callable, schema: str) -> DataFrame:
    """Arrow batches of df through ``each``, which turns one batch into columns."""
    reach_workers(df.sparkSession)
    fields = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            for columns in each(batch):
                yield pa.RecordBatch.from_arrays(list(columns), fields)

    return df.mapInArrow(run, schema)


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _anchors(length: int):
    def each(batch):
        data, ends = _texts(batch.column(2))
        raws = [data[i:j] for i, j in itertools.pairwise(ends.tolist())]
        if raws:
            text, _, _, anchor = units_of(raws, length)
            ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(raws)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(anchor))
            sizes = pa.array([len(raw) for raw in raws], pa.int64())
            yield batch.column(0), batch.column(1), sizes, lists

    return each


def _hulls(length: int):
    """Rows (text, base, chosen units): the bytes that the strings of each chosen unit span."""

    def each(batch):
        if not batch.num_rows:
            return
        data, ends = _texts(batch.column(0))
        raws = [data[i:j] for i, j in itertools.pairwise(ends.tolist())]
        bases, chosen = batch.column(1).to_numpy(), batch.column(2)
        owner, first, last, anchor = units_of(raws, length)
        begin = np.searchsorted(owner, np.arange(len(raws)))
        spot = np.sort(chosen.flatten().to_numpy() + np.repeat(begin, pc.list_value_length(chosen).to_numpy()))
        owner, lo, hi = owner[spot], first[spot], last[spot]
        # digests of the bytes between the first and the last string of a unit
        held, shift = data.data, ends[owner]
        hull = [
            hashlib.blake2b(held[i:j], digest_size=16).digest()
            for i, j in zip((lo + shift).tolist(), (hi + shift + length).tolist(), strict=True)
        ]
        yield (
            pa.array(bases[owner]),
            pa.array(lo),
            pa.array(hi),
            pa.array(anchor[spot]),
            pa.array(hull, pa.binary()),
        )

    return each


def _strings(length: int):
    """Rows (text, base, stretches): two names of each string that starts in a stretch."""

    def each(batch):
        for k in range(batch.num_rows):
            text, base, stretches = (batch.column(i)[k].as_py() for i in range(3))
            raw = _raw(text)
            cut = [raw[s["lo"] : s["hi"] + length] for s in stretches]
            for group in _grouped([len(c) for c in cut]):
                sizes = np.array([len(cut[i]) for i in group])
                joined = np.concatenate([cut[i] for i in group])
                low = np.array([stretches[i]["lo"] for i in group]) - (np.cumsum(sizes) - sizes)
                inside = np.arange(len(joined)) + length <= np.repeat(np.cumsum(sizes), sizes)
                spot = np.flatnonzero(inside)
                lists = [names(joined, length, lane)[spot].view(np.int64) for lane in (0, 1)]
                starts = spot + np.repeat(low, sizes)[spot]
                yield (
                    pa.array([base], pa.int64()),
                    *(pa.array([x], pa.list_(pa.int64())) for x in (*lists, starts)),
                )

    return each


def removed_starts(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, _text, runs): stretches of starts of strings that also start earlier.

    Documents are ordered by doc_id, null ids last, then by a hash of the text; rows with the same
    doc_id and text are one document. A third of all rows may be copies or share a passage: classes
    are formed by map-side minima, never gathered.
    """
    text = text_of(docs)
    keyed = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text).alias("_text"), text
    )
    found = stored(
        _read(
            keyed,
            _anchors(length),
            "doc_id bigint, _text bigint, size bigint, anchors array<bigint>",
        ),
        "anchors",
    )
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("_text")]
    # one place more than bytes: an empty text has a place of its own
    places = (F.col("size") + 1).alias("size")
    ranged = found.select("doc_id", "_text", places).distinct().repartitionByRange(*order)
    ranged = stored(
        ranged.withColumn("block", F.spark_partition_id()).withColumn("all", F.lit(0)), "order"
    )
    bases = running_starts(
        ranged.withColumn("last", F.col("doc_id").isNull()),
        ["all"],
        "block",
        ["last", "doc_id", "_text"],
        "size",
        "base",
    ).select("doc_id", "_text", "base")
    bases = stored(bases, "bases")

    # rank by anchors: unique ones drop out
    each = found.select("doc_id", "_text", F.posexplode("anchors").alias("unit", "anchor"))
    again = stored(
        each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
        "repeated-anchors",
    )
    chosen = (
        each.join(again.hint("shuffle_hash"), "anchor")
        .groupBy("doc_id", "_text")
        .agg(F.collect_set("unit").alias("units"))
    )
    chosen = stored(_by_text(chosen, bases).select("doc_id", "_text", "base", "units"), "chosen")

    # rank by everything that the strings of one anchor span
    texts = keyed.toDF("doc_id", "_text", "text")
    hulls = stored(
        _read(
            _by_text(texts, chosen).select("text", "base", "units"),
            _hulls(length),
            "base bigint, lo bigint, hi bigint, anchor bigint, hull binary",
        ),
        "hulls",
    )
    classes = stored(
        hulls.groupBy("anchor", "hull").agg(
            F.min(F.col("base") + F.col("lo")).alias("earliest"),
            F.max(F.col("base") + F.col("lo")).alias("latest"),
            # bases grow with positions, and strings that span equal bytes are equally many
            F.min("base").alias("base"),
            F.min(F.col("hi") - F.col("lo")).alias("width"),
        ),
        "hull-classes",
    )
    repeated = stored(
        hulls.join(
            classes.where("earliest < latest").select("anchor", "hull", "earliest").hint("shuffle_hash"),
            ["anchor", "hull"],
        )
        .where("base + lo > earliest")
        .groupBy("base")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("runs")),
        "repeated",
    )
    mixed = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    open_units = stored(
        classes.join(mixed.hint("shuffle_hash"), "anchor")
        .selectExpr("base", "earliest - base AS lo", "earliest - base + width AS hi")
        .groupBy("base")
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("stretches")),
        "open-units",
    )
    for done in (found, ranged, again, chosen, hulls, classes):
        discard(done)

    # rank what is left string by string
    strings = stored(
        _read(
            _by_text(texts, bases.join(open_units, "base")).select("text", "base", "stretches"),
            _strings(length),
            "base bigint, one array<bigint>, two array<bigint>, start array<bigint>",
        ),
        "strings",
    )
    each = strings.select(
        "base", F.explode(F.arrays_zip("one", "two", "start")).alias("s")
    ).select("base", "s.one", "s.two", "s.start")
    firsts = stored(
        each.groupBy("one", "two")
        .agg(
            F.min(F.col("base") + F.col("start")).alias("earliest"),
            F.max(F.col("base") + F.col("start")).alias("latest"),
        )
        .where("earliest < latest")
        .select("one", "two", "earliest"),
        "string-classes",
    )
    later = stored(
        each.join(firsts.hint("shuffle_hash"), ["one", "two"])
        .where("base + start > earliest")
        .groupBy("base")
        .agg(F.collect_list(F.struct(F.col("start").alias("lo"), F.col("start").alias("hi"))).alias("runs")),
        "later",
    )
    discard(strings)
    discard(firsts)
    runs = repeated.unionByName(later).groupBy("base").agg(
        F.flatten(F.collect_list("runs")).alias("runs")
    )
    return stored(bases.join(runs, "base").select("doc_id", "_text", "runs"), "runs")


def _by_text(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on document and text, null ids included."""
    other = right.withColumnRenamed("doc_id", "_d").withColumnRenamed("_text", "_t")
    same = left["doc_id"].eqNullSafe(other["_d"]) & (left["_text"] == other["_t"])
    return left.join(other, same, how).drop("_d", "_t")


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings, one after the other, and where each begins and ends."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), ends


def _cut(texts: pa.Array, runs: pa.Array, length: int) -> Iterator[tuple[range, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each few consecutive texts: their numbers, bytes and ends of the texts, which bytes go.

    Runs never reach over the end of their text, so many texts are marked in one table.
    """
    data, ends = _texts(texts)
    lo, hi = (part.to_numpy() for part in runs.flatten().flatten())
    counts = pc.fill_null(pc.list_value_length(runs), 0).to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for group in _grouped(np.diff(ends).tolist()):
        begin, end = ends[group.start], ends[group.stop]
        part = slice(bounds[group.start], bounds[group.stop])
        shift = np.repeat(ends[group.start : group.stop] - begin, counts[group.start : group.stop])
        edges = np.zeros(end - begin + 1, np.int32)
        np.add.at(edges, lo[part] + shift, 1)
        np.add.at(edges, hi[part] + length + shift, -1)
        gone = np.cumsum(edges, dtype=np.int32)[:-1] > 0
        yield group, data[begin:end], ends[group.start : group.stop + 1] - begin, gone


def suffix_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: n_bytes, bytes removed, maximal removed runs, digest of what is left.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier; strings are
    judged on the input and never cross documents. Null counts as empty. Rows with the same doc_id
    and text are one document and get the same result.
    """

    def each(batch):
        for group, raw, ends, gone in _cut(batch.column(1), batch.column(2), length):
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            begins = ends[:-1][ends[:-1] < len(raw)]
            first[begins] = gone[begins]
            removed, spans = (
                np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends] for x in (gone, first)
            )
            left, kept = raw[~gone].data, ends - removed
            digests = [hashlib.sha256(left[i:j]).hexdigest() for i, j in itertools.pairwise(kept.tolist())]
            numbers = (pa.array(np.diff(x), pa.int64()) for x in (ends, removed, spans))
            own = batch.column(0).slice(group.start, len(group))
            yield own, *numbers, pa.array(digests, pa.string())

    text = text_of(docs)
    keyed = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(text).alias("_text"), text.alias("text"))
    joined = _by_text(keyed, removed_starts(docs, length), "left").select("doc_id", "text", "runs")
    return _read(
        joined, each, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without the removed bytes, all columns; every row stays.

    A letter that loses some of its bytes is lost whole. ``n_chars``, where there is one, is
    counted anew. Null texts stay null, empty ones empty; rows with the same doc_id and text are one
    document; long texts are cut like others. An empty table gives no rows.
    """
    runs = removed_starts(docs, length).toDF("_d", "_t", "_r")
    names_ = {c: fresh(docs, c) for c in ("_d", "_t", "_r")}
    for old, new in names_.items():
        runs = runs.withColumnRenamed(old, new)
    d, t, r = names_.values()
    same = docs["doc_id"].cast("bigint").eqNullSafe(runs[d]) & (F.xxhash64(text_of(docs)) == runs[t])
    joined = docs.join(runs, same, "left").select(*quoted(docs), r)
    spot = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts, runs = batch.column(spot), batch.column(len(docs_columns))
            cut = texts.to_pylist()
            some = pc.fill_null(pc.list_value_length(runs), 0).to_numpy() > 0
            for group, raw, ends, gone in _cut(texts, runs, length):
                for k in np.flatnonzero(some[group.start : group.stop]).tolist():
                    part = slice(ends[k], ends[k + 1])
                    left = raw[part][~gone[part]].tobytes()
                    cut[group.start + k] = left.decode("utf-8", "ignore")
            columns = list(batch.columns[:-1])
            columns[spot] = pa.array(cut, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    reach_workers(docs.sparkSession)
    cut = by_position(joined).mapInArrow(run, docs.schema)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.char_length("text").cast(kind)).select(quoted(docs))
