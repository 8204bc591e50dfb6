"""SimHash near-duplicates, linked through BK-trees.

A document's fingerprint has a bit set where more than half of its shingles' 64-bit hashes have
it.  Fingerprints within ``radius`` bits of each other are linked, and documents of one
component of these links are near-duplicates.

The fingerprints are dealt out to shards so that two of them within the radius meet in one: the
64 bits are cut into blocks, and as few bits differ, some blocks are equal.  Each shard is a
BK-tree, whose children are keyed by their Hamming distance to the parent; a search follows
only edges within the radius of the distance to the node.  A shard with many fingerprints is
sent to several tasks, each of which searches the whole tree for its share of them.

Shards reach their searches by a shuffle and not as broadcast variables: all trees together
grow with the corpus, so a broadcast of them has no bound.

Defined results: null and empty texts have fingerprint zero and are linked to one another;
repeated rows stay in the result; ties go to the smallest id, a null id last; an empty table
gives an empty result.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankmatch.llm.common import by_texts, column, free_name, plain, small_batches
from rankmatch.llm.components import components
from rankmatch.session import store

BITS = 64
# Fingerprints of one shard that one task searches for; a larger shard goes to several tasks.
SLICE = 2048
# Fingerprints a task searches for at a time, together with the nodes they may meet.
FRONTIER = 1 << 21
_STRIDE = BITS + 1
_SHINGLES = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of a whole UTF-8 text; A-Z are lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, _SHINGLES):
        part = [digest(line[s : e - 1], seed) for s, e in zip(starts[k : k + _SHINGLES], last[k : k + _SHINGLES])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _of_texts(values: pa.Array, shingle: int, seed: int) -> pa.Array:
    texts = pc.cast(values, pa.large_binary()).to_pylist()
    return pa.array(np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64))


def fingerprints(
    docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed 64-bit number, for every row."""
    texts = plain(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            found = _of_texts(batch.column(1), shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "fp"])

    return by_texts(texts, run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fp bigint")


class Forest:
    """BK-trees over distinct fingerprints, one for each run of equal ``tree`` numbers."""

    def __init__(self, prints: np.ndarray, tree: np.ndarray):
        """All trees are built at once, level by level; the result is that of inserting in order."""
        self.prints = prints
        first = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
        self.root = np.repeat(first, np.diff(np.append(first, len(tree))))
        waiting = np.setdiff1d(np.arange(len(prints)), first)
        at, slots, children = self.root[waiting], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(waiting):
            slot = at * _STRIDE + np.bitwise_count(prints[waiting] ^ prints[at])
            taken, which, back = np.unique(slot, return_index=True, return_inverse=True)
            slots.append(taken)
            children.append(waiting[which])
            rest = np.ones(len(waiting), bool)
            rest[which] = False
            at, waiting = waiting[which][back][rest], waiting[rest]
        slots, children = np.concatenate(slots), np.concatenate(children)
        order = np.argsort(slots)
        self.slots, self.children = slots[order], children[order]

    def within(self, wanted: np.ndarray, radius: int):
        """Pairs (fingerprint, other one of its tree) within the radius, for the nodes ``wanted``."""
        query, node = wanted, self.root[wanted]
        while len(query):
            far = np.bitwise_count(self.prints[query] ^ self.prints[node]).astype(np.int64)
            near = (far <= radius) & (query != node)
            yield query[near], node[near]
            # Only children at a distance the triangle inequality allows.
            low = np.searchsorted(self.slots, node * _STRIDE + np.maximum(far - radius, 0))
            high = np.searchsorted(self.slots, node * _STRIDE + np.minimum(far + radius, BITS), "right")
            count = high - low
            skip = np.repeat(low - np.append(0, np.cumsum(count)[:-1]), count)
            query, node = np.repeat(query, count), self.children[skip + np.arange(int(count.sum()))]


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a`` and ``b`` in ``root``, which holds each node's smallest known one."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        a, b = a[differ], b[differ]
        np.minimum.at(root, high[differ], low[differ])
        while not np.array_equal(root, above := root[root]):
            root[:] = above


def _links(prints: np.ndarray, tree: np.ndarray, part: np.ndarray, parts: np.ndarray, radius: int):
    """Each fingerprint with the first one of its shard that the shard's links tie it to."""
    forest = Forest(prints.view(np.uint64), tree)
    place = np.arange(len(prints)) - forest.root
    wanted = np.flatnonzero(place % parts == part)
    sizes = np.bincount(forest.root, minlength=len(prints))[forest.root[wanted]]
    root = np.arange(len(prints))
    for some in np.split(wanted, np.flatnonzero(np.diff(np.cumsum(sizes) // FRONTIER)) + 1):
        for a, b in forest.within(some, radius):
            merge(root, a, b)
    tied = root != np.arange(len(prints))
    return prints[tied], prints[root[tied]]


def _search(radius: int):
    def run(batches):
        kept: list[list[np.ndarray]] = []

        def found(rows):
            columns = [np.concatenate(x) for x in zip(*rows)]
            shard = np.cumsum(np.append(0, np.any(np.stack([np.diff(c) != 0 for c in columns[:3]]), axis=0)))
            a, b = _links(columns[3], shard, columns[2], columns[4], radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            # Shards are complete up to where the last one of this batch begins.
            other = np.any(np.stack([c[:-1] != c[-1] for c in now[:3]]), axis=0)
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if not cut and kept and any(x[-1][-1] != c[0] for x, c in zip(zip(*kept), now[:3])):
                yield found(kept)
                kept = []
            if cut:
                yield found([*kept, [c[:cut] for c in now]])
                kept = []
            kept.append([c[cut:] for c in now])
        if kept:
            yield found(kept)

    return run


def shard_masks(n: int, radius: int) -> list[int]:
    """Bits that make a shard's key, so that fingerprints within the radius agree on one of the masks.

    The number of blocks follows the number ``n`` of fingerprints, so that a shard of evenly
    spread fingerprints stays small; it decides the work and never the result.
    """
    for blocks in range(radius + 1, radius + 5):
        edges = [BITS * i // blocks for i in range(blocks + 1)]
        pieces = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
        if n <= 16 << ((blocks - radius) * (BITS // blocks)):
            break
    return [sum(chosen) for chosen in combinations(pieces, blocks - radius)]


def link(prints: DataFrame, radius: int = 3, column_name: str = "fp") -> DataFrame:
    """``node`` and ``root`` for every distinct fingerprint that is linked to a smaller one."""
    distinct = store(prints.select(column(column_name).alias("fp")).where("fp IS NOT NULL").distinct(), "prints")
    masks = shard_masks(distinct.count(), radius)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in signed])
    dealt = distinct.select(F.posexplode(keys).alias("mask", "key"), "fp")
    sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / SLICE).cast("int")
    shards = (
        dealt.join(sizes, ["mask", "key"])
        .select("mask", "key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "fp", parts.alias("parts"))
        .repartition("mask", "key", "part")
        .sortWithinPartitions("mask", "key", "part", "fp")
    )
    return components(shards.mapInArrow(_search(radius), "a bigint, b bigint"), "a", "b")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, ``fingerprint`` in 16 hex digits and ``component_id``, the smallest id of its component."""
    prints = store(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("component_id"))
    linked = link(prints, radius)
    rooted = first.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "component_id"
    )
    rooted = store(rooted, "rooted")
    whole = rooted.groupBy("root").agg(F.min("component_id").alias("component_id"))
    groups = rooted.select("fp", "root").join(whole, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest id.

    Where several rows have this id and fingerprint, any one of them stays.
    """
    name = free_name(docs.columns, "__fp")
    helper = free_name(docs.columns, "__text")
    wide = docs.withColumn(helper, F.coalesce(column(text_col).cast("string"), F.lit("")))

    def run(batches):
        for batch in batches:
            found = _of_texts(batch.column(batch.num_columns - 1), shingle, seed)
            rest = batch.select(range(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*rest.columns, found], names=[*rest.schema.names, name])

    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    tagged = store(wide.mapInArrow(run, schema), "tagged")
    prints = tagged.select(column(name).alias("fp"), column(id_col).alias("id"))
    counts = prints.groupBy("fp", "id").agg(F.count("*").alias("rows"))
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "fp", "rows")
    first = counts.groupBy("fp").agg(F.min(rank).alias("first"))
    linked = link(prints, radius)
    keys = [free_name(tagged.columns, f"__kept_{c}") for c in ("fp", "id", "rows")]
    kept = (
        first.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        .groupBy(F.coalesce("root", "fp"))
        .agg(F.min("first").alias("first"))
        .select(*[F.col(f"first.{c}").alias(k) for c, k in zip(("fp", "id", "rows"), keys)])
    )
    kept = store(kept, "kept")
    same = (column(name) == column(keys[0])) & column(id_col).eqNullSafe(column(keys[1]))
    chosen = tagged.join(kept, same)
    columns = [column(c) for c in docs.columns]
    if kept.where(column(keys[2]) > 1).isEmpty():
        return chosen.select(columns)
    single = chosen.where(column(keys[2]) == 1).select(columns)
    several = chosen.where(column(keys[2]) > 1).dropDuplicates([name]).select(columns)
    return single.union(several)
