"""Near-duplicates by order MinHash, verified by banded alignment.

A sketch takes the few smallest of all occurrence-labelled pieces of two or three words under one
hash function and keeps them in their order in the text; texts that differ by few edits share sketches, texts
that hold the same pieces in another order do not. Texts that share a sketch form a bucket. Each
is compared with one representative of all its buckets, then, where a bucket still holds several
classes, with its best linked member, and at last all those of a bucket that are still in different
classes with each other, unless their lengths or words alone rule out a link.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuloom.llm.common import (
    BLANKS,
    discard,
    fresh,
    may_hold,
    quoted,
    reach_workers,
    salted_join,
    stored,
    text_of,
)

#: Pieces of a sketch and the least similarity of a link that the sketches below are made for.
CHOSEN, SIMILARITY = 2, 0.8
#: Words of a piece, sketches of a text, and the least and most words of the texts that have them.
#: The ranges overlap by the lengths of a link, so that each link has a kind that both texts have.
KINDS = ((2, 60, 12, 100), (3, 60, 80, None))
#: Most words of texts whose links are found without loss, by what is left after few deletions.
SHORT = 14
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(6).integers(1, 1 << 63, sum(k[1] for k in KINDS), np.uint64) | np.uint64(1)
#: First band of an alignment beyond the difference in length, and lines that share one table.
_BAND, _STRETCH = 120, 4096
#: Words up to which the values of all sketches are formed at once.
_TOGETHER = 50_000
#: Counters of words in a profile, and members of a bucket's block that meet those of another one.
_BINS, _BLOCK = 256, 400
#: Texts that a worker holds as words at a time, and words it holds to compare texts of a block.
_TEXTS, _WORDS = 500, 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_names(words: list[bytes]) -> np.ndarray:
    first = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    return first | np.fromiter(map(zlib.adler32, words), np.uint64, len(words)) << np.uint64(32)


def _hashed(rows: np.ndarray) -> np.ndarray:
    """One value of each row of names."""
    out = np.full(len(rows), rows.shape[1], np.uint64)
    for k in range(rows.shape[1]):
        out = _mix(out * _MIX + rows[:, k])
    return out


def _remainders(name: np.ndarray) -> np.ndarray:
    """Values of what is left of a short text after as many deletions as its longest link has edits.

    Two texts within d edits share what is left after d deletions or fewer in each.
    """
    n = len(name)
    edits = int((1 - SIMILARITY) * min(int(n / SIMILARITY + 1e-9), SHORT) + 1e-9)
    left = [np.array(list(itertools.combinations(range(n), n - k))) for k in range(edits + 1)]
    return np.unique(np.concatenate([_hashed(name[rows]) for rows in left]))


def _order_sketches(name: np.ndarray, piece: int, seeds: np.ndarray) -> np.ndarray:
    """One order-MinHash value per seed."""
    whole = np.zeros(len(name) - piece + 1, np.uint64)
    for k in range(piece):
        whole = _mix(whole * _MIX + name[k : k + len(whole)])
    # label each piece with the number of equal ones before it
    _, kind = np.unique(whole, return_inverse=True)
    order = np.argsort(kind, kind="stable")
    same = np.concatenate([[0], np.cumsum(np.bincount(kind))])[:-1]
    label = np.empty(len(kind), np.uint64)
    label[order] = np.arange(len(kind)) - same[kind[order]]
    labelled = _mix(whole + label * np.uint64(0xD6E8FEB86659FD93))
    rows = len(seeds) if len(labelled) <= _TOGETHER else 1
    chosen = np.empty((len(seeds), CHOSEN), np.uint64)
    for k in range(0, len(seeds), rows):
        value = labelled * seeds[k : k + rows, None]
        spots = np.empty((len(value), CHOSEN), np.int64)
        for i in range(CHOSEN):
            spots[:, i] = value.argmin(axis=1)
            np.put_along_axis(value, spots[:, i : i + 1], np.uint64(0xFFFFFFFFFFFFFFFF), axis=1)
        chosen[k : k + rows] = labelled[np.sort(spots, axis=1)]
    return _mix(_hashed(chosen) + seeds)


def sketches(words: list[str]) -> list[int]:
    """Values of which texts with a link share one; texts of under four words have none.

    Up to ``SHORT`` words: all remainders. Order MinHash for longer ones, of word pairs up to 100
    words and of three words beyond.
    """
    return _sketches(_mix(word_names([w.encode() for w in words]))).tolist()


def _sketches(name: np.ndarray) -> np.ndarray:
    found, first = [np.zeros(0, np.uint64)], 0
    if 4 <= len(name) <= SHORT:
        found.append(_remainders(name))
    for piece, count, least, most in KINDS:
        if least <= len(name) <= (most or len(name)):
            found.append(_order_sketches(name, piece, _SEEDS[first : first + count]))
        first += count
    return np.concatenate(found).view(np.int64)


def edit_distance(a: Sequence, b: Sequence, most: int) -> int:
    """Edits between two sequences, or most + 1 if there are more: alignment inside a band.

    The band starts narrow and widens until the distance lies inside it.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    head = 0
    while head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not len(b):
        return len(a)
    band = len(a) - len(b) + _BAND
    while band < most:
        found = _by_rows(a, b, band)
        if found <= band:
            return found
        band *= 4
    return _by_rows(a, b, most)


def _by_rows(a: Sequence, b: Sequence, most: int) -> int:
    """Edits of two sequences inside the band of ``most``, or most + 1: one word of ``b`` at a time.

    A line of cells is held as bits: which are one more (``up``) or one less (``down``) than the
    cell before. The window moves along the diagonal by one cell a line; an alignment of at most
    ``most`` edits never leaves it. Edits are counted along the diagonal that ends in the last cell.
    """
    if len(a) < len(b):
        a, b = b, a
    longer = len(a) - len(b)
    above = (most - longer) // 2
    width = longer + 2 * above + 1
    full, goal = (1 << width) - 1, 1 << (above + longer)
    up, down, edits = full >> above << above, 0, longer
    for begin in range(0, len(b), _STRETCH):
        lines = b[begin : begin + _STRETCH]
        # places in ``a`` that the windows of these lines cover, as bits of each of their words
        places, first = dict.fromkeys(lines, 0), begin - above
        for i in range(max(0, first), min(len(a), first + len(lines) + width)):
            if a[i] in places:
                places[a[i]] |= 1 << (i - first)
        for shift, word in enumerate(lines):
            equal = places[word] >> shift & full
            free = (((equal & up) + up) ^ up | equal | down) & full
            if not free & goal:
                edits += 1
                if edits > most:
                    return most + 1
            right, left = down | full ^ (free | up), free & up
            free >>= 1
            up, down = left | full ^ (free | right), free & right
    return edits


def similar(a: list[str], b: list[str], least: float = SIMILARITY) -> bool:
    """Whether one minus edits per words of the longer text is ``least`` or more."""
    return _similar(a, Counter(a), b, Counter(b), least)


def _similar(a: list[str], in_a: Counter, b: list[str], in_b: Counter, least: float) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    common = sum((in_a & in_b).values())
    if longer - common > most:
        return False
    return edit_distance(a, b, most) <= most


def words_key(docs: DataFrame) -> Column:
    """Digest of the sequence of words; texts without words share one."""
    plain = F.trim(F.regexp_replace(text_of(docs), BLANKS, " "))
    return F.unhex(F.md5(plain.cast("binary")))


def _profile(name: np.ndarray) -> bytes:
    """Words counted in ``_BINS`` classes, up to 255 each; an edit changes two counts by one at most."""
    found = np.bincount((name % np.uint64(_BINS)).astype(np.int64), minlength=_BINS)
    return np.minimum(found, 255).astype(np.uint8).tobytes()


def _sketched(docs: DataFrame) -> DataFrame:
    """Of each document its id, the digest of its words as ``words_key`` has it, sketches and profile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(k, _TEXTS) for b in batches for k in range(0, b.num_rows, _TEXTS))
        for part in parts:
            words = [t.split() for t in part.column(1).to_pylist()]  # bytes part at ``BLANKS``
            names = [_mix(word_names(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([hashlib.md5(b" ".join(w)).digest() for w in words], pa.binary()),
                    pa.array(map(_sketches, names), pa.list_(pa.int64())),
                    pa.array(map(len, words), pa.int64()),
                    pa.array(map(_profile, names), pa.binary()),
                ],
                ["doc_id", "digest", "sketches", "words", "bins"],
            )

    text = F.make_valid_utf8(text_of(docs)).cast("binary").alias("text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], text).mapInArrow(
        run, f"doc_id {kind}, digest binary, sketches array<bigint>, words bigint, bins binary"
    )


def _bins(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, _BINS).astype(np.int16)


def _may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether profiles of n and m words leave room for a link; each edit replaces one word at most."""
    change = x - y
    gone = np.maximum(change, 0).sum(-1, dtype=np.int64)
    come = gone - change.sum(-1, dtype=np.int64)
    most = ((1 - least) * np.maximum(n, m) + 1e-9).astype(np.int64)
    return np.maximum(np.maximum(gone, come), np.abs(n - m)) <= most


def _possible(pairs: DataFrame, profiles: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that lengths and word counts do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            good = _may_link(_bins(batch.column(3)), _bins(batch.column(5)), n, m, least)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    both = pairs.join(profiles.toDF("a", "n", "x"), "a")
    both = both.join(profiles.toDF("b", "m", "y"), "b")
    return both.select("a", "b", "n", "x", "m", "y").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [similar(p.split(" "), q.split(" "), least) for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(
                pa.array(good, pa.bool_())
            )

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _linked(pairs: DataFrame, own: DataFrame, profiles: DataFrame, least: float) -> DataFrame:
    """The pairs that are links; ``own`` has the texts of all nodes that can be in a pair.

    One ``a`` may be in a third of all pairs; adaptive execution splits its partition of the joins.
    """
    pairs = stored(_possible(pairs, profiles, least), "possible")
    filled = pairs.join(own.toDF("a", "x"), "a")
    filled = filled.join(own.toDF("b", "y"), "b")
    links = stored(_verified(filled.select("a", "b", "x", "y"), least), "verified")
    discard(pairs)
    return links


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, plain) of ``nodes`` (node, digest), once each. A filter of fixed size spares most other
    texts the shuffle."""
    keyed = docs.select(words_key(docs).alias("digest"), text_of(docs).alias("text"))
    some = may_hold(keyed, F.col("digest"), nodes.select("digest"), "_some").where("_some")
    some = some.dropDuplicates(["digest"]).join(nodes, "digest")
    return some.select("node", F.trim(F.regexp_replace("text", BLANKS, " ")).alias("plain"))


def _low_high(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("low"), F.greatest(one, other).alias("high")]


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """(a, b): hubs and the texts of other classes in their buckets, each two texts once."""
    pairs = entries.where("class <> hub.class").select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    once = pairs.groupBy(*_low_high("a", "b")).agg(F.min(F.struct("a", "b")).alias("pair"))
    return once.select("pair.a", "pair.b")


def _bucket_minima(entries: DataFrame) -> DataFrame:
    """(key, a) of the buckets of two texts or more; minima are formed before the shuffle."""
    return (
        entries.groupBy("key")
        .agg(F.min("node").alias("a"), F.max("node").alias("z"))
        .where("a < z")
        .select("key", "a")
    )


def _undecided(entries: DataFrame) -> DataFrame:
    """Entries (key, node, class, links) of buckets with several classes; adds the bucket's size and
    ``hub``, its member with the most links."""
    hub = F.max(F.struct("links", "node", "class")).alias("hub")
    keys = entries.groupBy("key").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("size"), hub
    )
    keys = stored(keys.where("low < high").select("key", "size", "hub"), "undecided-keys")
    return entries.join(keys.hint("shuffle_hash"), "key")


def _by_block(
    batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """What ``work`` makes of the rows of each block; the rows come in the order of ``block``."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            table, rest = rest, None
        else:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
        if table is None or not table.num_rows:
            continue
        key = table["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        if batch is not None:  # the last block may go on in the next batch
            rest = table.slice(cuts[-2])
            cuts.pop()
        for begin, end in itertools.pairwise(cuts):
            if end - begin > 1:
                yield from work(table.slice(begin, end - begin))


def _candidates(table: pa.Table, least: float) -> list[tuple[int, int]]:
    """Places of the rows of a block that profiles allow a link, each two texts in one bucket only."""
    words, side = table["words"].to_numpy(), table["side"].to_numpy()
    kind, bins = table["class"].to_numpy(), _bins(table["bins"])
    order = np.argsort(words, kind="stable")
    words, side, kind, bins = words[order], side[order], kind[order], bins[order]
    # the longer text of a link has at most this many words
    ends = np.searchsorted(words, words / least + 1e-6, side="right")
    own = table["key"].to_pylist()
    keys = functools.cache(lambda i: frozenset(table["keys"][i].as_py()))
    found = []
    for i in range(len(order)):
        j = np.arange(i + 1, ends[i])
        j = j[(kind[j] != kind[i]) & ((side[j] != side[i]) | (side[i] == 2))]
        if len(j):
            j = j[_may_link(bins[j], bins[i], words[j], words[i], least)]
            one = int(order[i])
            for two in order[j].tolist():
                if own[one] == own[two] == min(keys(one) & keys(two)):
                    found.append((one, two))
    return found


def _cross_links(entries: DataFrame, profiles: DataFrame, own: DataFrame, least: float) -> DataFrame:
    """The links (a, b) of texts of different classes in one bucket.

    The members of a bucket are dealt into blocks of about ``_BLOCK``, and each two blocks meet in a
    task of their own choice. Only texts that profiles allow a link there are sent on, now with their
    words, to meet once more; no row stands for a pair before it is a link.
    """
    blocks = F.ceil(F.col("size") / F.lit(_BLOCK)).cast("int")
    place = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    lists = entries.groupBy("node").agg(F.collect_set("key").alias("keys"))
    dealt = (
        entries.join(profiles.select("node", "words", "bins").join(lists, "node"), "node")
        .withColumn("blocks", blocks)
        .withColumn("own", place)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("key", low, high).alias("block"), "key", "node", "class", "words", side.alias("side"), "bins", "keys")
    )

    def hopeful(table: pa.Table) -> Iterator[pa.RecordBatch]:
        spots = sorted(set(itertools.chain.from_iterable(_candidates(table, least))))
        if spots:
            yield from table.take(pa.array(spots)).combine_chunks().to_batches()

    def linked(table: pa.Table) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(max(2, _WORDS // max(1, max(table["words"].to_pylist()))))
        def text(i: int) -> tuple[list[str], Counter]:
            words = table["plain"][i].as_py().split(" ")
            return words, Counter(words)

        pairs = [(i, j) for i, j in _candidates(table, least) if _similar(*text(i), *text(j), least)]
        if pairs:
            node = table["node"].to_numpy()
            a, b = node[np.array(pairs)].T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def sorted_(df: DataFrame) -> DataFrame:
        return df.repartition("block").sortWithinPartitions("block")

    some = sorted_(dealt).mapInArrow(lambda batches: _by_block(batches, hopeful), dealt.schema)
    filled = sorted_(stored(some, "hopeful").join(own, "node"))
    links = filled.mapInArrow(lambda batches: _by_block(batches, linked), "a bigint, b bigint")
    return stored(links, "verified")


def components(links: DataFrame) -> DataFrame:
    """(node, class): the smallest node that links lead to.

    Each node points to its smallest neighbour or itself, pointers are followed to their ends, and the
    links between different ends are the next round's. A round leaves at most half of the nodes, and
    of a large group with one centre none; the links of a node never meet its other ones.
    """
    edges, label = links.select("a", "b"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        step = stored(near.select("node", F.least("node", "low").alias("class")), "labels")
        while True:
            # ends point to themselves; only pointers to others that go on are followed
            onward = step.where("class <> node").toDF("class", "further")
            ahead = step.join(onward, "class", "left")
            ahead = stored(
                ahead.select("node", F.coalesce("further", "class").alias("class"), F.col("further").isNotNull().alias("moved")),
                "labels",
            )
            discard(step)
            step, moved = ahead.select("node", "class"), not ahead.where("moved").isEmpty()
            if not moved:
                break
        if label is None:
            label = step
        else:
            further = step.toDF("class", "further")
            new = label.join(further, "class", "left")
            new = stored(new.select("node", F.coalesce("further", "class").alias("class")), "labels")
            discard(label)
            discard(step)
            label = new
        ends = label.toDF("a", "one")
        crossing = links.select("a", "b").join(ends, "a")
        crossing = crossing.join(ends.toDF("b", "two"), "b").where("one <> two")
        edges = stored(crossing.select(F.col("one").alias("a"), F.col("two").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return label


def _with_classes(table: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``table`` with the class and the number of links of each node."""
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    known = stored(classes.join(degree.toDF("node", "links"), "node"), "known")
    return table.join(known, "node", "left").withColumns(
        {"class": F.coalesce("class", "node"), "links": F.coalesce("links", F.lit(0))}
    )


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(node, class, n_links) of texts with links, and (doc_id, node, _row) of all documents.

    ``node`` is the digest of a text, ``class`` that of one text of its class, ``n_links`` counts the
    verified links of the text to different ones. Inside, texts are known by numbers.

    Each text meets the smallest representative of its buckets. Where a bucket still has several
    classes, its texts of other classes meet its member with the most links, twice, since only the
    first time shows which members those are. Then all texts of a bucket that are in different
    classes meet. After that no link between two classes of one bucket is untested.
    """
    reach_workers(docs.sparkSession)
    number = F.monotonically_increasing_id()
    every = stored(_sketched(docs), "sketches")
    rows = stored(every.select("doc_id", F.col("digest").alias("node"), number.alias("_row")), "near-rows")
    sketched = every.drop("doc_id").dropDuplicates(["digest"]).sortWithinPartitions("digest")
    sketched = stored(sketched.withColumn("node", number), "sketched")
    discard(every)

    entries = sketched.select("node", F.explode("sketches").alias("key"))
    least_of = stored(_bucket_minima(entries), "sketch-groups")
    members = stored(entries.join(least_of.hint("shuffle_hash"), "key"), "members")
    discard(least_of)
    first = stored(members.groupBy("node").agg(F.min("a").alias("a")), "representatives")
    # what the rounds need of the texts that share a sketch
    met = stored(sketched.drop("sketches").join(first.select("node"), "node"), "profiles")
    discard(sketched)
    profiles, digests = met.select("node", "words", "bins"), met.select("node", "digest")
    own = stored(_texts_of(docs, digests), "pair-texts")

    tested = stored(first.where("a < node").select("a", F.col("node").alias("b")), "pairs")
    links = _linked(tested, own, profiles, least)
    classes = components(links)
    open_ = stored(_undecided(_with_classes(members.select("key", "node"), classes, links)), "undecided")
    discard(members)
    for turn in range(3):
        if turn < 2:
            pairs = _hub_pairs(open_)
            known = tested.select(*_low_high("a", "b"))
            pairs = pairs.select("a", "b", *_low_high("a", "b")).join(known, ["low", "high"], "left_anti")
            pairs = stored(pairs.select("a", "b"), "more-pairs")
            more = _linked(pairs, own, profiles, least)
            tested = tested.unionByName(pairs)
        else:
            more = _cross_links(open_.select("key", "node", "class", "size"), profiles, own, least)
        if more.isEmpty():
            continue
        links = links.unionByName(more)
        classes = components(links)
        if turn < 2:
            before = open_
            open_ = stored(_undecided(_with_classes(open_.select("key", "node"), classes, links)), "undecided")
            discard(before)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
    named = classes.join(degree.agg(F.count(F.lit(1)).alias("n_links")), "node")
    named = named.join(digests.withColumnRenamed("digest", "_own"), "node")
    named = named.join(digests.toDF("class", "_lead"), "class")
    named = named.select(F.col("_own").alias("node"), F.col("_lead").alias("class"), "n_links")
    named = stored(named, "near-classes")
    for done in (met, first, own, tested, open_):
        discard(done)
    return named, rows


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_links, kept.

    A link holds between two different texts when one minus the word edits per words of the longer
    one is ``least`` or more; classes are connected by links and by equal word sequences.
    ``class_id`` is the smallest doc_id of the class (null ids last), ``n_links`` counts the
    links of the text that were verified to form the class (which ones depends on the shuffle partitions too), and exactly one row of each class is kept: that of ``class_id``,
    of tied rows any one. Null and blank texts are equal to one another. Texts under four words
    are linked to equal ones only. Pairs of at most 14 words meet in a bucket without loss, others by
    chance: in a simulation with edits at random places none of 17,400 pairs at similarity 0.8 to
    0.9 was missed, with substitutions at even distances up to 3 % of those at 0.8 with over 100 words.
    ``least`` below 0.8 is checked, but not searched for as thoroughly.
    """
    known, rows = near_classes(docs, least)
    named = stored(
        salted_join(rows, known, ["node"], "left").select(
            "doc_id",
            "_row",
            F.coalesce("class", "node").alias("class"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ),
        "near-named",
    )
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("_row"))
    firsts = named.groupBy("class").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("class_size")
    )
    return salted_join(named, stored(firsts, "near-firsts"), ["class"], "left").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        "n_links",
        (F.col("_row") == F.col("first._row")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns: that of the smallest doc_id, of ties any one.

    Null texts count as empty, and blank ones equal them; an empty table gives no rows; repeated rows
    are one class; long texts are compared whole. Texts of classes of one row stay where they are:
    a filter of fixed size lets only (and all) others through to the shuffle.
    """
    known, rows = near_classes(docs, least)
    node, cls = fresh(docs, "_node"), fresh(docs, "_class")
    classes = known.select("node", "class").toDF(node, cls)
    rows = rows.select("doc_id", F.col("node").alias(node))
    named = salted_join(rows, classes, [node], "left").withColumn(cls, F.coalesce(cls, node))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col(node))
    firsts = named.groupBy(cls).agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("low")
    )
    # classes of one row need no decision; the others are known by the text that stays
    owner, stay = fresh(docs, "_id"), fresh(docs, "_stay")
    many = stored(firsts.where("rows > 1"), "near-firsts")
    winners = many.select(F.col(f"first.{node}").alias(node), F.col("first.doc_id").alias(owner))
    members = stored(
        classes.unionByName(many.select(F.col(cls).alias(node), F.col(cls)))
        .distinct()
        .join(many.select(cls), cls, "left_semi")
        .join(winners.withColumn(stay, F.lit(True)), node, "left"),
        "near-members",
    ).withColumn(stay, F.coalesce(stay, F.lit(False)))
    shared = fresh(docs, "_shared")
    keyed = docs.withColumn(node, words_key(docs))
    marked = may_hold(keyed, F.col(node), members.select(node), shared)
    alone = marked.where(~F.col(shared)).select(quoted(docs))
    joined = salted_join(marked.where(F.col(shared)), members.drop(cls), [node], "left")
    chosen = joined.where(
        F.col(stay).isNull() | (F.col(stay) & docs["doc_id"].eqNullSafe(F.col(owner)))
    )
    # of the rows that pass, those of one text tie, so one of them stays
    first = chosen.groupBy(node).agg(F.first(F.struct(*quoted(docs))).alias(owner))
    return alone.unionByName(first.select(f"{owner}.*"))
