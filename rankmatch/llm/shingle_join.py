"""Documents linked by the Jaccard likeness of their word shingles, found through PartEnum signatures.

Sizes are cut into bands so that two sets that are similar enough lie in one band or in neighbouring
ones.  Within a band, similar sets differ in at most ``k`` shingles.  The domain of shingles is dealt
to ``n1`` partitions, each to ``n2`` smaller ones, both by the shingle's hash.  By the pigeonhole
principle some partition has at most ``k2`` of the differences, so some ``n2 - k2`` of its smaller
partitions hold the same shingles of both sets.  A signature is the content of one such subset of one
partition, so similar sets share a signature.  A set signs for its own band and for the next one.

Equal sets are one node.  Of the sets that share a signature, first only the smallest is compared with
the others, which ties groups of copies together without their pairs.  Then sets that share a signature
and still lie in different components are compared, in tiles, so no link is lost and no group is held
whole.  A comparison first needs sizes and the parities of 512 hash classes to allow a link, and then
counts the common shingles of both texts.

Sets and shingles are told apart by 64-bit hashes.

Defined results: A-Z count as lower case.  A text of fewer words than a shingle has its whole
sequence as its one shingle; a null, empty or blank text has the empty set, links to nothing and is a
component of its own.  Repeated rows stay in the result; a null id is never the smallest unless its
component has no other.  Texts of any length are read whole, by pieces that end at a blank.  An empty
table gives an empty result.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import BLANKS, WordHashes, by_texts, mixed, plain, strings, word_bounds
from rankmatch.llm.components import components
from rankmatch.operators.joins import attach
from rankmatch.session import store

# Bytes of text that the vectorised scans look at in one go; a longer text has several pieces.
PIECE = 1 << 20
# Sets of one signature that are compared with one another at a time.
TILE = 1024
# Sets a task remembers so as not to sign their copies again.
REMEMBERED = 1 << 18
SKETCH = 512
_WORDS = SKETCH // 64
_LIMIT = 1 << 40


@dataclass(frozen=True)
class Scheme:
    """Signatures for sets with 100 * common >= ``percent`` * united.

    ``differences`` is k2, how many of the ``pieces`` (n2) of a partition may differ.
    """

    percent: int = 90
    differences: int = 1
    pieces: int = 3

    @cached_property
    def bands(self) -> np.ndarray:
        """The largest size of each band; the smallest is one more than the largest before."""
        ends, low = [0], 1
        while low < _LIMIT:
            ends.append(low * 100 // self.percent)
            low = ends[-1] + 1
        return np.array(ends, np.int64)

    @cached_property
    def far(self) -> np.ndarray:
        """k of each band: the most shingles in which similar sets of up to its largest size differ."""
        return 2 * self.bands * (100 - self.percent) // (100 + self.percent)

    @cached_property
    def partitions(self) -> np.ndarray:
        """n1 of each band; 0 where only equal sets are similar."""
        return np.where(self.far > 0, -(-(self.far + 1) // (self.differences + 1)), 0)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bands, sizes)

    def subsets(self) -> np.ndarray:
        """Which pieces each subset of a partition has: subsets x pieces."""
        keep = self.pieces - self.differences
        return np.array([[m >> j & 1 for j in range(self.pieces)] for m in range(1 << self.pieces) if m.bit_count() == keep], bool)

    def sign(self, shingles: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of consecutive sets and how many each has."""
        found, owner = [], []
        chosen = self.subsets()
        half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
        spread, second = shingles >> half, ((shingles & low) * np.uint64(self.pieces)) >> half
        for ahead in (0, 1):
            band = self.band(lengths) + ahead
            parts = np.where(lengths > 0, self.partitions[band], 0)
            begin = np.append(0, np.cumsum(parts))
            of_set = np.repeat(np.arange(len(lengths)), lengths)
            signs = parts[of_set] > 0
            first = (spread * parts[of_set].astype(np.uint64)) >> half
            cell = (begin[of_set] + first.astype(np.int64)) * self.pieces + second.astype(np.int64)
            sums = np.zeros(int(begin[-1]) * self.pieces, np.uint64)
            np.add.at(sums, cell[signs], mixed(shingles[signs] + np.uint64(1)))
            sums = sums.reshape(-1, self.pieces)
            of_part = np.repeat(np.arange(len(lengths)), parts)
            place = np.arange(len(of_part)) - begin[of_part]
            for s, pieces in enumerate(chosen):
                tag = ((band[of_part] << 40) + (place << 8) + s).astype(np.uint64)
                found.append(mixed(sums[:, pieces].sum(axis=1, dtype=np.uint64) ^ mixed(tag + np.uint64(1))))
                owner.append(of_part)
        found, owner = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return found[order], np.bincount(owner, minlength=len(lengths))


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, begin of each part, its text): whole texts of about a piece, long ones cut at blanks."""
    starts, owners, begin = [], [], int(ends[0])
    for text in range(len(ends) - 1):
        at, end = int(ends[text]), int(ends[text + 1])
        while True:
            cut = end
            if end - at > PIECE:
                # The first blank from the limit on, so that no word is cut.
                step = at + PIECE
                while step < end and not (blank := _BLANK[data[step : step + PIECE]]).any():
                    step += PIECE
                cut = step + int(np.argmax(blank)) if step < end else end
            if starts and cut - begin > PIECE:
                yield data[begin:at], np.array(starts) - begin, np.array(owners)
                starts, owners, begin = [], [], at
            starts.append(at)
            owners.append(text)
            at = cut
            if at >= end:
                break
    if starts:
        yield data[begin : int(ends[-1])], np.array(starts) - begin, np.array(owners)


def text_sets(values: pa.Array, shingle: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of consecutive texts, and how many each has."""
    data, ends = strings(values)
    words, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if len(values):
        for block, starts, texts in _pieces(data, ends):
            low = _LOWER[block]
            begin, end = word_bounds(low, starts)
            words.append(mixed(hashes(low, begin, end)))
            owners.append(texts[np.searchsorted(starts, begin, "right") - 1])
    words, owners = np.concatenate(words), np.concatenate(owners)
    counts = np.bincount(owners, minlength=len(values)) if len(values) else np.zeros(0, np.int64)
    edges = np.append(0, np.cumsum(counts))
    found, lengths = [np.zeros(0, np.uint64)], np.zeros(len(values), np.int64)
    for text in np.flatnonzero(counts):
        own = words[edges[text] : edges[text + 1]]
        width = min(shingle, len(own))
        n = len(own) - width + 1
        joined = np.full(n, width, np.uint64)
        for k in range(width):
            joined = mixed(joined + own[k : k + n])
        joined = np.unique(joined)
        found.append(joined)
        lengths[text] = len(joined)
    return np.concatenate(found), lengths


def _ragged(values: np.ndarray, lengths: np.ndarray, missing: np.ndarray) -> pa.Array:
    offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32), mask=np.append(missing, False))
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def set_numbers(shingles: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One number for the content of each set."""
    sums = np.zeros(len(lengths), np.uint64)
    np.add.at(sums, np.repeat(np.arange(len(lengths)), lengths), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    return mixed(sums + lengths.astype(np.uint64)).view(np.int64)


def parities(shingles: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per set, the parity of the number of its shingles in each of 512 classes, as 64-bit words.

    Sets that differ in d shingles differ in at most d of these bits.
    """
    cell = np.repeat(np.arange(len(lengths)), lengths) * SKETCH + (mixed(shingles) % np.uint64(SKETCH)).astype(np.int64)
    odd = (np.bincount(cell, minlength=len(lengths) * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, SKETCH), axis=1).view(np.int64)


_SKETCH = [f"s{i}" for i in range(_WORDS)]


def signed(docs: DataFrame, shingle: int = 3, scheme: Scheme = Scheme(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with ``n`` and ``set_id``; the first row of a set in a task also has its signatures and parities."""
    texts = plain(docs, id_col, text_col)

    def run(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            shingles, lengths = text_sets(batch.column(1), shingle, hashes)
            numbers = set_numbers(shingles, lengths)
            new = np.zeros(len(lengths), bool)
            for i in np.flatnonzero(lengths):
                if int(numbers[i]) not in seen:
                    new[i] = True
                    seen.add(int(numbers[i]))
            if len(seen) > REMEMBERED:
                seen.clear()
            own = shingles[np.repeat(new, lengths)]
            some = np.where(new, lengths, 0)
            signatures, counts = scheme.sign(own, some)
            bits = parities(own, some)
            columns = [
                batch.column(0),
                pa.array(lengths),
                pa.array(numbers, mask=lengths == 0),
                _ragged(signatures, counts, ~new),
                *[pa.array(bits[:, i], mask=~new) for i in range(_WORDS)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "set_id", "signatures", *_SKETCH])

    kind = texts.schema["doc_id"].dataType.simpleString()
    sketch = ", ".join(f"{c} bigint" for c in _SKETCH)
    return by_texts(texts, run, f"doc_id {kind}, n bigint, set_id bigint, signatures array<bigint>, {sketch}")


def _groups(batches):
    """Sorted (signature, set) rows to the rows of signatures with several sets, each with the smallest one.

    The first and the last signature of a task may go on in the neighbouring one, so they are
    always kept and marked.
    """

    def found(sig: np.ndarray, sets: np.ndarray, edge: np.ndarray):
        change = np.append(True, sig[1:] != sig[:-1]) if len(sig) else np.zeros(0, bool)
        start = np.flatnonzero(change)
        size = np.diff(np.append(start, len(sig)))
        pivot = np.repeat(sets[start], size)
        keep = (np.repeat(size, size) > 1) | edge
        return pa.RecordBatch.from_arrays(
            [pa.array(sig[keep]), pa.array(sets[keep]), pa.array(pivot[keep]), pa.array(edge[keep])],
            names=["signature", "set_id", "pivot", "edge"],
        )

    sig, sets, first = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        a, b = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(a):
            continue
        sig, sets = np.concatenate([sig, a]), np.concatenate([sets, b])
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (sets[1:] != sets[:-1]))
        sig, sets = sig[fresh], sets[fresh]
        first = sig[0] if first is None else first
        last = int(np.searchsorted(sig, sig[-1]))
        if last:
            yield found(sig[:last], sets[:last], sig[:last] == first)
            sig, sets = sig[last:], sets[last:]
    if len(sig):
        yield found(sig, sets, np.ones(len(sig), bool))


def shared_signatures(rows: DataFrame) -> DataFrame:
    """``signature``, ``set_id``, ``pivot``, ``edge``: the sets of every signature that several sets have.

    Signatures are put in order by ranges of (signature, set), so that one which very many sets have
    lies in several tasks; there each task has a pivot of its own.
    """
    one = rows.where("signatures IS NOT NULL").select(F.explode("signatures").alias("signature"), "set_id")
    sorted_rows = one.repartitionByRange("signature", "set_id").sortWithinPartitions("signature", "set_id")
    return sorted_rows.mapInArrow(_groups, "signature bigint, set_id bigint, pivot bigint, edge boolean")


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _allowed(percent: int) -> Column:
    """Whether sizes and parities of the sets a and b leave room for a link."""
    differ = sum((F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in _SKETCH), F.lit(0))
    united = F.col("a_n") + F.col("b_n")
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return sizes & ((100 + percent) * differ <= (100 - percent) * united)


def _side(info: DataFrame, side: str) -> DataFrame:
    return info.select(F.col("set_id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", *_SKETCH)])


class _Sets:
    """The shingles of sets, read again from one text of each where a comparison needs them."""

    def __init__(self, docs: DataFrame, rows: DataFrame, shingle: int, id_col: str, text_col: str):
        self.texts = plain(docs, id_col, text_col).withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        self.where = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min(key).alias("key"))
        self.shingle = shingle

    def of(self, wanted: DataFrame) -> DataFrame:
        """``set_id`` and its ``shingles`` for the sets of ``wanted``."""
        shingle = self.shingle
        keys = attach(self.where, wanted, ["set_id"], "left_semi")
        texts = attach(self.texts, keys.select("key").distinct(), ["key"], "left_semi").select("text")

        def run(batches):
            hashes = WordHashes()
            for batch in batches:
                shingles, lengths = text_sets(batch.column(0), shingle, hashes)
                numbers = set_numbers(shingles, lengths)
                # Copies within a batch once.
                _, once = np.unique(numbers, return_index=True)
                keep = np.zeros(len(lengths), bool)
                keep[once] = True
                keep &= lengths > 0
                own, some = shingles[np.repeat(keep, lengths)], lengths[keep]
                listed = _ragged(own, some, np.zeros(len(some), bool))
                yield pa.RecordBatch.from_arrays([pa.array(numbers[keep]), listed], names=["set_id", "shingles"])

        found = by_texts(texts, run, "set_id bigint, shingles array<bigint>")
        return attach(found, wanted, ["set_id"], "left_semi").groupBy("set_id").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough, counted shingle by shingle."""
    both = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    known = store(sets.of(store(both, "wanted-sets")), "sets")
    one = known.select(F.col("set_id").alias("a"), F.col("shingles").alias("a_shingles"))
    two = known.select(F.col("set_id").alias("b"), F.col("shingles").alias("b_shingles"))
    joined = attach(attach(pairs, one, ["a"], "inner"), two, ["b"], "inner")
    common = F.size(F.array_intersect("a_shingles", "b_shingles")).cast("long")
    united = F.size("a_shingles").cast("long") + F.size("b_shingles") - common
    return store(joined.where(100 * common >= percent * united).select("a", "b"), "set-links")


def links(
    docs: DataFrame, rows: DataFrame, shingle: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``node`` and ``root`` for every set that is linked, over others too, to a smaller one.

    ``rows`` are those of :func:`signed`, stored.
    """
    sets = _Sets(docs, rows, shingle, id_col, text_col)
    info = rows.where("signatures IS NOT NULL").select("set_id", "n", *_SKETCH).distinct()
    info = store(info, "set-sizes")
    shared = store(shared_signatures(rows), "signatures")

    # First the smallest set of each signature with the others; the pivots of one signature in
    # several tasks with the smallest of them.
    stars = shared.where("pivot <> set_id").select(*_pairs(F.col("pivot"), F.col("set_id")))
    ends = shared.where("edge").select("signature", "pivot").distinct()
    least = ends.groupBy("signature").agg(F.min("pivot").alias("least"))
    across = ends.join(least, "signature").where("pivot <> least").select(*_pairs(F.col("pivot"), F.col("least")))
    tried = store(stars.union(across).distinct(), "first-pairs")
    sized = attach(attach(tried, _side(info, "a"), ["a"], "inner"), _side(info, "b"), ["b"], "inner")
    first = _verified(store(sized.where(_allowed(percent)).select("a", "b"), "close-pairs"), sets, percent)

    # Then the sets of a signature that are still apart.
    roots = store(components(first, "a", "b").withColumnRenamed("node", "set_id"), "first-roots")
    rooted = attach(shared.select("signature", "set_id"), roots, ["set_id"])
    rooted = rooted.withColumn("root", F.coalesce("root", "set_id"))
    apart = (
        rooted.groupBy("signature")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("__rows"))
        .where("low <> high")
        .select("signature", "__rows", F.ceil(F.col("__rows") / TILE).cast("int").alias("tiles"))
    )
    open_rows = attach(attach(rooted, apart, ["signature"], "inner").drop("__rows"), info, ["set_id"], "inner")
    open_rows = store(open_rows.withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")), "open-sets")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))

    def dealt(side: str, own: str, other: str) -> DataFrame:
        columns = [F.col(c).alias(f"{side}_{c}") for c in ("set_id", "root", "n", *_SKETCH)]
        return open_rows.select("signature", F.col("tile").alias(own), every.alias(other), *columns)

    met = dealt("a", "t", "u").join(dealt("b", "u", "t"), ["signature", "t", "u"])
    met = met.where((F.col("a_set_id") < F.col("b_set_id")) & (F.col("a_root") != F.col("b_root")) & _allowed(percent))
    pairs = met.select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b")).distinct()
    pairs = store(attach(pairs, tried, ["a", "b"], "left_anti"), "later-pairs")
    second = _verified(pairs, sets, percent)
    known = roots.withColumnRenamed("set_id", "node")
    if second.isEmpty():
        return known
    # The stars found first stand for their links.
    return components(known.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second), "a", "b")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    scheme: Scheme | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id of the document's component."""
    scheme = scheme or Scheme(percent)
    rows = store(signed(docs, shingle, scheme, id_col, text_col), "signed")
    tied = links(docs, rows, shingle, percent, id_col, text_col)
    sets = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"))
    rooted = attach(sets, tied.withColumnRenamed("node", "set_id"), ["set_id"])
    rooted = store(rooted.select("set_id", "first", F.coalesce("root", "set_id").alias("root")), "rooted-sets")
    whole = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = attach(rooted.select("set_id", "root"), whole, ["root"], "inner").select("set_id", "component_id")
    found = attach(rows.select("doc_id", "n", "set_id"), named, ["set_id"])
    alone = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))
