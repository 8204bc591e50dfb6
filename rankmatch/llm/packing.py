"""Variable-capacity best-fit packing of documents into training sequences.

A sequence may have one of several lengths, counted in words.  Documents are dealt to shards by
a hash, as many as rows and words demand, and each shard is packed alone: longest piece first,
into the open bin it leaves least room in.  Where none has room, a bin of the length that costs
least per word it can expect to hold is opened.  The shard is packed twice for each length, as the
longest that may be opened and as the one that is, wherever the piece fits; every bin is then
downsized to the smallest length that holds its contents, and the packing of least total cost
stays.

A document longer than the longest sequence is cut into pieces of that length and a rest, and
all of them are packed.

Defined results: a null or empty text is one piece of no words and lies in some bin; null and
repeated ids and equal rows are packed like any other; ties go to the bin opened first; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import WORD, column, small_batches
from rankmatch.llm.mixing import words

_WORD = re.compile(WORD)
_STEP = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``capacities`` in words, ascending; a sequence of L words costs ``fixed`` + L + L * L / ``square``.

    A shard has about ``shard_rows`` documents and ``shard_words`` words; more documents mean more
    shards, so a task's memory has a bound.
    """

    capacities: tuple[int, ...] = (512, 1024, 2048, 4096)
    fixed: float = 16.0
    square: float = 32768.0
    shard_rows: int = 4096
    shard_words: int = 4_000_000
    seed: int = 23

    def cost(self, length: int) -> float:
        return self.fixed + length + length * length / self.square


@dataclass
class Packing:
    """Of each piece its bin and where it begins there; of each bin its length and contents."""

    bins: list[int]
    offsets: list[int]
    capacities: list[int]
    used: list[int]
    cost: float = 0.0


def _opened(length: int, rest: int, limit: int, free: bool, settings: Settings) -> int:
    """The length to open for a piece: ``limit``, or if ``free`` the one up to it of least cost per word it can hold.

    A piece that does not fit gets the shortest length it fits.
    """
    fits = [c for c in settings.capacities if c >= length]
    allowed = [c for c in fits if c <= limit] or fits[:1]
    if not free:
        return allowed[-1]
    return min(allowed, key=lambda c: (settings.cost(c) / max(min(c, length + rest), 1), c))


def _packed(lengths: Sequence[int], limit: int, free: bool, settings: Settings) -> Packing:
    """Best fit of lengths in falling order; see :func:`_opened` for the bins."""
    result = Packing([], [], [], [])
    rooms: list[int] = []
    open_bins: dict[int, list[int]] = {}
    rest = sum(lengths)
    for length in lengths:
        rest -= length
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            ready = open_bins[room]
            number = ready.pop(0)
            if not ready:
                rooms.pop(at)
                del open_bins[room]
        else:
            number, room = len(result.capacities), _opened(length, rest, limit, free, settings)
            result.capacities.append(room)
            result.used.append(0)
        result.bins.append(number)
        result.offsets.append(result.used[number])
        result.used[number] += length
        room -= length
        if room not in open_bins:
            insort(rooms, room)
            open_bins[room] = []
        insort(open_bins[room], number)
    # Downsize every bin to what it holds.
    for number, used in enumerate(result.used):
        result.capacities[number] = next(c for c in settings.capacities if c >= used)
    result.cost = sum(map(settings.cost, result.capacities))
    return result


def pack(lengths: Sequence[int], settings: Settings = Settings()) -> Packing:
    """The cheapest packing of lengths in falling order, none above the longest capacity."""
    tried = [_packed(lengths, limit, free, settings) for limit in settings.capacities for free in (True, False)]
    return min(tried, key=lambda p: p.cost)


def _pieces(sizes: Sequence[int], longest: int) -> list[tuple[int, int, int]]:
    """(length, row, first word) of every piece, longest first."""
    found = []
    for row, size in enumerate(sizes):
        for first in range(0, max(size, 1), longest):
            found.append((min(longest, size - first), row, first))
    return sorted(found, key=lambda p: (-p[0], p[1], p[2]))


def _dealt(docs: DataFrame, settings: Settings, id_col: str, text_col: str, keep_text: bool) -> DataFrame:
    """doc_id, size, mark and shard of every row, and its text if asked for.

    The shard also hashes the number of the reading task, so equal rows do not meet in one.
    """
    text: Column = column(text_col).cast("string")
    mark = F.xxhash64(F.lit(settings.seed), column(id_col), text)
    total = docs.agg(F.count("*"), F.coalesce(F.sum(words(text)), F.lit(0))).first()
    shards = max(-(-total[0] // settings.shard_rows), -(-total[1] // settings.shard_words), 1)
    shard = F.pmod(F.xxhash64(mark, F.spark_partition_id()), F.lit(shards)).cast("int")
    return docs.select(
        column(id_col).alias("doc_id"), mark.alias("mark"), shard.alias("shard"),
        *([F.coalesce(text, F.lit("")).alias("text")] if keep_text else [words(text).alias("size")]),
    )


def assign(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every piece of every row: where it lies and what it is.

    doc_id, ``piece``, ``first_word``, ``n_words``, ``bin_id``, ``capacity`` and ``begin``, its
    place in the bin.  Only ids and sizes are shuffled.
    """
    rows = _dealt(docs, settings, id_col, text_col, keep_text=False)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("mark", "ascending"), ("size", "ascending")]).combine_chunks()
        pieces = _pieces(group["size"].to_pylist(), settings.capacities[-1])
        packing = pack([p[0] for p in pieces], settings)
        base = group["shard"][0].as_py() * _STEP
        length, row, first = (np.array(x, np.int64) for x in zip(*pieces))
        bins = np.array(packing.bins, np.int64)
        return pa.table(
            {
                "doc_id": group["doc_id"].take(pa.array(row)),
                "piece": (first // settings.capacities[-1]).astype(np.int32),
                "first_word": first,
                "n_words": length,
                "bin_id": bins + base,
                "capacity": np.array(packing.capacities, np.int32)[bins],
                "begin": np.array(packing.offsets, np.int64),
            }
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("shard").applyInArrow(
        run,
        f"doc_id {kind}, piece int, first_word bigint, n_words bigint, bin_id bigint, capacity int, begin bigint",
    )


def _part(text: str, first: int, length: int, size: int) -> str:
    if first == 0 and length == size:
        return text
    found = [m.span() for m in _WORD.finditer(text)]
    return text[found[first][0] : found[first + length - 1][1]]


def sequences(
    docs: DataFrame,
    settings: Settings = Settings(),
    separator: str = "\n\n",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per bin: ``bin_id``, ``capacity``, ``n_words``, ``doc_ids`` and ``text``, in the order packed.

    Texts are shuffled once, to their shards; ``separator`` is blank and adds no word.
    """
    rows = _dealt(docs, settings, id_col, text_col, keep_text=True)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("mark").combine_chunks()
        texts = group["text"].to_pylist()
        sizes = [len(_WORD.findall(t)) for t in texts]
        pieces = _pieces(sizes, settings.capacities[-1])
        packing = pack([p[0] for p in pieces], settings)
        base = group["shard"][0].as_py() * _STEP
        held: list[list[tuple[int, int, int]]] = [[] for _ in packing.capacities]
        for piece, number in zip(pieces, packing.bins):
            held[number].append(piece)
        rows_of = pa.array([r for h in held for _, r, _ in h], pa.int64())
        ends = pa.array(np.cumsum([0, *map(len, held)]), pa.int32())
        ids = group["doc_id"].combine_chunks()
        return pa.table(
            {
                "bin_id": np.arange(len(held)) + base,
                "capacity": np.array(packing.capacities, np.int32),
                "n_words": np.array(packing.used, np.int64),
                "doc_ids": pa.ListArray.from_arrays(ends, ids.take(rows_of)),
                "text": [separator.join(_part(texts[r], f, n, sizes[r]) for n, r, f in h) for h in held],
            }
        )

    small_batches(docs.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("shard").applyInArrow(
        run, f"bin_id bigint, capacity int, n_words bigint, doc_ids array<{kind}>, text string"
    )
