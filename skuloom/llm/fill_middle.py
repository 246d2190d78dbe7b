"""Fill-in-middle transformation: cuts at units found by a Fenwick tree over text blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import reach_workers, text_of

#: Bytes of text per leaf of the tree.
BLOCK = 1024
UNITS = ("line", "character")


@dataclass(frozen=True)
class FillPlan:
    """How texts are transformed.

    ``fim_rate`` of 100 texts are cut at all, ``spm_rate`` of 100 of these put the suffix first.
    A marker must not begin inside itself or inside another one; the defaults do not.
    """

    seed: int = 7
    fim_rate: int = 100
    spm_rate: int = 50
    unit: str = "line"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if self.unit not in UNITS:
            raise ValueError(f"unit is one of {UNITS}")
        if not all(marks):
            raise ValueError("markers must not be empty")
        for own in marks:
            for other in marks:
                whole = own != other and own in other
                if whole or any(own.endswith(other[:k]) for k in range(1, len(other))):
                    raise ValueError("a marker begins inside another one")


class BlockTree:
    """Fenwick tree over blocks of ``BLOCK`` bytes of UTF-8.

    Node i sums the blocks (i - lowbit(i), i]: column 0 the line ends, column 1 the code points
    that begin there.
    """

    def __init__(self, text: bytes) -> None:
        self.raw = np.frombuffer(text, np.uint8)
        self.begins = (self.raw & 0xC0) != 0x80
        self.blocks = -(-len(self.raw) // BLOCK)
        sums = np.zeros((self.blocks + 1, 2), np.int64)
        if self.blocks:
            at = np.arange(0, len(self.raw), BLOCK)
            sums[1:, 0] = np.add.reduceat(self.raw == 10, at, dtype=np.int64)
            sums[1:, 1] = np.add.reduceat(self.begins, at, dtype=np.int64)
            np.cumsum(sums, axis=0, out=sums)
        node = np.arange(self.blocks + 1)
        self.tree = sums - sums[node - (node & -node)]
        self.lines, self.points = (int(x) for x in sums[-1])

    def units(self, unit: str) -> int:
        """How many units the text has; a last line needs no end."""
        if unit == "character":
            return self.points
        return self.lines + bool(len(self.raw) and self.raw[-1] != 10)

    def _block_of(self, k: int, column: int) -> tuple[int, int, int]:
        """Block of the k-th count of a column, its rank in there, code points before the block."""
        at = points = 0
        step = 1 << max(self.blocks, 1).bit_length() - 1
        while step:
            there = at + step
            if there <= self.blocks and self.tree[there, column] < k:
                at = there
                k -= int(self.tree[there, column])
                points += int(self.tree[there, 1])
            step >>= 1
        return at, k, points

    def boundary(self, k: int, unit: str) -> tuple[int, int]:
        """Byte offset and code points of the end of the first k units."""
        if k == 0:
            return 0, 0
        if k == self.units(unit):
            return len(self.raw), self.points
        if unit == "line":
            block, rank, points = self._block_of(k, 0)
            inside = self.raw[block * BLOCK : (block + 1) * BLOCK] == 10
            end = int(np.flatnonzero(inside)[rank - 1]) + 1
        else:  # the next code point begins where the first k end
            block, rank, points = self._block_of(k + 1, 1)
            inside = self.begins[block * BLOCK : (block + 1) * BLOCK]
            end = int(np.flatnonzero(inside)[rank - 1])
        begin = block * BLOCK
        return begin + end, points + int(self.begins[begin : begin + end].sum())


def transform(text: bytes, doc_id: str, plan: FillPlan) -> tuple:
    """n, form, code points of prefix and middle (None if plain) and the output of one text."""
    tree = BlockTree(text)
    n = tree.units(plan.unit)
    name = hashlib.sha256(f"{plan.seed}:{doc_id}".encode()).hexdigest()
    draws = [int(name[8 * k : 8 * k + 8], 16) for k in range(4)]
    p, s, m = (mark.encode() for mark in (plan.prefix, plan.suffix, plan.middle))
    if not text or draws[2] % 100 >= plan.fim_rate or any(mark in text for mark in (p, s, m)):
        return n, "plain", None, None, text
    first, second = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    a, points_a = tree.boundary(first, plan.unit)
    b, points_b = tree.boundary(second, plan.unit)
    head, body, tail = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < plan.spm_rate:
        return n, "spm", points_a, points_b - points_a, b"".join((s, tail, p, head, m, body))
    return n, "psm", points_a, points_b - points_a, b"".join((p, head, s, tail, m, body))


def fill_middle(docs: DataFrame, plan: FillPlan | None = None) -> DataFrame:
    """Every document with its middle moved to the end: doc_id, n, form, lengths and ``output``.

    ``n`` counts the units (lines, each with its end; a last line needs none). The seed and the
    ``doc_id`` decide the two cuts and the form: ``plain`` leaves the text as it is, ``psm`` puts
    prefix, suffix, middle, ``spm`` suffix, prefix, middle. Empty texts, texts that contain a
    marker and those above the rate are plain; null texts count as empty. Null ids are hashed as
    an empty id. Repeated rows get the same cuts, a row each. An empty table gives no rows. A long
    text costs one pass to count its blocks, then a descent of the tree per cut. Extra columns are
    not read.
    """
    plan = plan or FillPlan()
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n", "form", "prefix_chars", "middle_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            ids = batch.column(1).to_pylist()
            rows = [transform(t, i, plan) for t, i in zip(texts, ids, strict=True)]
            parts = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            output = pa.array([r[4] for r in rows], pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *parts, output], ["doc_id", *names, "output"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own_id = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"], own_id, text_of(docs)).mapInArrow(
        run,
        f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output string",
    )


def restored(output: Column, form: Column, plan: FillPlan | None = None) -> Column:
    """The text that an output of ``fill_middle`` with the same plan was made of."""
    plan = plan or FillPlan()

    def between(begin: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, begin, -1), end, 1)

    body = F.substring_index(output, plan.middle, -1)
    psm = F.concat(between(plan.prefix, plan.suffix), body, between(plan.suffix, plan.middle))
    spm = F.concat(between(plan.prefix, plan.middle), body, between(plan.suffix, plan.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
