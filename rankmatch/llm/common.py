"""Helpers shared by the text operators: small Arrow batches, text buffers, words, sampling."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than these six ASCII blanks.
BLANKS = b" \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of an Arrow batch: a task holds one batch of texts at a time.
BATCH_ROWS = 400
# Bytes of text that the vectorised scans look at in one go.
BLOCK_BYTES = 1 << 20


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` of ``docs``; a null text counts as empty."""
    return docs.select(
        column(id_col).alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text")
    )


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the texts a Python worker holds at a time; no result depends on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def by_texts(docs: DataFrame, function, schema: str) -> DataFrame:
    """``docs.mapInArrow(function, schema)`` with small batches."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(function, schema)


class Shared:
    """A broadcast model whose classes travel by value too, so a task can read it without this package."""

    def __init__(self, spark: SparkSession, value: object):
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self.read = None

    def __getstate__(self):
        return {"held": self.held, "read": None}

    @property
    def value(self):
        if self.read is None:
            self.read = pickle.loads(self.held.value)
        return self.read


def free_name(taken: Sequence[str], wish: str) -> str:
    """``wish``, lengthened until no column in ``taken`` has it, in whatever case."""
    lower = {c.lower() for c in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish


def sampled_ids(labels: DataFrame, label: str, per_class: int, seed: int) -> DataFrame:
    """At most ``per_class`` ids of each class of a table (doc_id, ``label``), by a seeded hash.

    The result has at most twice ``per_class`` rows, so it may be broadcast.
    """
    order = [F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id")]
    return (
        labels.where(F.col(label) == 1)
        .orderBy(*order)
        .limit(per_class)
        .union(labels.where(F.col(label) == 0).orderBy(*order).limit(per_class))
    )


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, seed: int, id_col: str, text_col: str
) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels to learn from, and the share of class 1 among all labelled rows.

    One row of each of at most ``per_class`` ids of either class is taken, the least of its texts of at most
    ``max_chars`` code points: so at most ``2 * per_class * max_chars`` code points reach the driver,
    however many rows have one id.  An id labelled as both classes counts as class 0.
    """
    known = labels.select(column(id_col).alias("doc_id"), column(label).alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)"
    )
    share = known.agg(F.avg(F.col("label").cast("double"))).first()[0]
    ids = sampled_ids(known.distinct(), "label", per_class, seed)
    rows = (
        plain(docs, id_col, text_col)
        .join(F.broadcast(ids), "doc_id")
        .where(F.length("text") <= max_chars)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("label").alias("label"))
        .toPandas()
        .sort_values("doc_id")
    )
    return rows["text"].tolist(), rows["label"].to_numpy(), 0.5 if share is None else share


def strings(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and where each of its values begins and ends."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    wide = pa.types.is_large_string(values.type)
    buffers = values.buffers()
    n = len(values)
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[values.offset : values.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, ends.astype(np.int64)


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True


def blocks(data: np.ndarray, ends: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple]:
    """(bytes, piece starts, document of each piece): consecutive documents, about ``limit`` bytes.

    A longer document is cut into pieces, each at the last blank before its limit or, without
    one, at the limit.  The cuts depend on the document alone.
    """
    starts, owners, begin = [], [], int(ends[0]) if len(ends) else 0
    for doc in range(len(ends) - 1):
        at, end = int(ends[doc]), int(ends[doc + 1])
        while True:
            cut = end
            if end - at > limit:
                blank = np.flatnonzero(_BLANK[data[at : at + limit]])
                cut = at + (int(blank[-1]) + 1 if len(blank) else limit)
            if starts and cut - begin > limit:
                yield data[begin:at], np.array(starts) - begin, np.array(owners)
                starts, owners, begin = [], [], at
            starts.append(at)
            owners.append(doc)
            at = cut
            if at >= end:
                break
    if starts:
        yield data[begin : int(ends[-1])], np.array(starts) - begin, np.array(owners)


def overlapping(data: np.ndarray, ends: np.ndarray, limit: int = BLOCK_BYTES, reach: int = 3) -> Iterator[tuple]:
    """:func:`blocks`, and how many bytes at the begin of a block were in the block before as well.

    A document over ``limit`` bytes comes as blocks of its own, each beginning with the last word of the one
    before and at least ``reach`` of its bytes, so that no pair of words and no n-gram of up to ``reach`` + 1
    bytes is lost at a cut.  Only a word over ``limit`` bytes counts as several.
    """
    first, n = 0, len(ends) - 1
    for doc in [*np.flatnonzero(np.diff(ends) > limit).tolist(), n]:
        if doc > first:
            for block, starts, owners in blocks(data, ends[first : doc + 1], limit):
                yield block, starts, owners + first, 0
        if doc < n:
            text = data[int(ends[doc]) : int(ends[doc + 1])]
            at = back = 0
            while at < len(text):
                cut = len(text)
                if cut - at > limit:
                    blank = np.flatnonzero(_BLANK[text[at : at + limit]])
                    cut = at + (int(blank[-1]) + 1 if len(blank) else limit)
                yield text[back:cut], np.zeros(1, np.int64), np.array([doc]), at - back
                low = max(cut - limit, 0)
                ink = ~_BLANK[text[low:cut]]
                begin = np.flatnonzero(ink[1:] & ~ink[:-1])
                back = max(min(cut - reach, low + 1 + int(begin[-1]) if len(begin) else cut - reach), 0)
                at = cut
        first = doc + 1


def word_bounds(block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of a block; a piece start always begins a new word."""
    ink = ~_BLANK[block]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    inner = starts[(starts > 0) & (starts < len(block))]
    first[inner] = ink[inner]
    last[inner - 1] = ink[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_BASE = 0x9E3779B97F4A7C15 | 1


class WordHashes:
    """64-bit polynomial hashes of the words of a block, all at once."""

    def __init__(self, size: int = 0):
        self.grow(size)

    def grow(self, size: int) -> None:
        up, down = np.full(size + 1, _BASE, np.uint64), np.full(size + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def __call__(self, block: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(block) >= len(self.up):
            self.grow(max(len(block), 2 * len(self.up)))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * self.up[: len(block)], out=sums[1:])
        return (sums[end] - sums[begin]) * self.down[begin]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
