"""How far the sources of a language diverge in their terms: hash-consed segment trees of counts.

Every (language, source) group has a segment tree over the language's term ids whose leaves are the
group's counts.  Nodes are hash-consed: two subtrees of equal counts are one node, wherever they lie
and whichever group has them, so the long runs of rare terms that a source lacks are a few nodes.
The distance of two groups is priced by walking both trees at once from the roots: the pairs of nodes
met on a level are merged with their number, so that equal node pairs are followed and priced once.

A language's term ids are dealt to blocks by a hash of the term; a block is one subtree of bounded
size, the sum over the blocks is that of the whole tree.  Within a block, terms lie by falling counts.
Sources are dealt to tiles, so a task has one block of two tiles however many sources there are.

Counts are exact integers and estimates are exact quotients; no floating point is used.

Defined results: null texts, languages and sources count as ''.  A group without terms has zero
counts; a language without kept terms gives its pairs the value 0 and no term rows; a language with
one source gives no pair.  Repeated rows are documents of their own; ties go by the item's UTF-8
bytes.  Very long texts are read whole, one batch at a time.  An empty table gives an empty result.
Ids and other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmatch.llm.common import by_texts, column
from rankmatch.operators.joins import attach
from rankmatch.session import store

# What separates terms, and the scale and smoothing of the estimates.
SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
SMOOTHING = 5
# Terms of a block and sources of a tile, about: what a task prices at a time.
BLOCK_TERMS = 1024
TILE_SOURCES = 32
# Counts that a task merges before it passes them on.
HELD = 1 << 19

_ABSENT = 0


def _text(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def _batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences ``n`` and documents ``docs`` of each term of each group in one batch.

    A row with the empty term stands for the group itself.
    """
    lang, source, text = batch.columns
    words = pc.split_pattern_regex(pc.ascii_lower(text), SEPARATOR)
    spread = pc.list_flatten(words).dictionary_encode()
    terms = spread.dictionary
    # Every row has a group; an empty text or edge gives the empty term anyway, so add it to all.
    groups: dict[tuple, int] = {}
    of_row = np.array([groups.setdefault(g, len(groups)) for g in zip(lang.to_pylist(), source.to_pylist())], np.int64)
    docs = np.repeat(np.arange(len(text)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    width = max(len(terms), 1)
    per_doc, times = np.unique(docs * width + spread.indices.to_numpy(zero_copy_only=False), return_counts=True)
    pair = of_row[per_doc // width] * width + per_doc % width
    found, back = np.unique(pair, return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, back, times)
    names = list(groups)
    which = found // width
    columns = {
        "lang": pa.array([g[0] for g in names], pa.string()).take(pa.array(which)),
        "source": pa.array([g[1] for g in names], pa.string()).take(pa.array(which)),
        "term": terms.cast(pa.string()).take(pa.array(found % width)),
        "n": pa.array(n),
        "docs": pa.array(np.bincount(back, minlength=len(found)).astype(np.int64)),
    }
    table = pa.table(columns)
    table = table.filter(pc.not_equal(table["term"], ""))
    own = {
        "lang": pa.array([g[0] for g in names], pa.string()),
        "source": pa.array([g[1] for g in names], pa.string()),
        "term": pa.array([""] * len(names), pa.string()),
        "n": pa.array(np.zeros(len(names), np.int64)),
        "docs": pa.array(np.bincount(of_row, minlength=len(names)).astype(np.int64)),
    }
    return pa.concat_tables([table, pa.table(own)])


_KEYS = ["lang", "source", "term"]


def _merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return both.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def _count(batches):
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_batch_counts(batch))
        rows += held[-1].num_rows
        if rows > HELD:
            held = [_merged(held)]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from _merged(held).to_batches()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs``, over all rows.

    The row of the empty term has the documents of the group.  Counts are merged within the tasks
    before the shuffle, so a source with a third of all rows adds no more than a task each.
    """
    texts = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source"), _text(text_col).alias("text"))
    counted = by_texts(texts, _count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def estimate(count: Column, below: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / below), in exact decimals."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(2,0)"))
    return F.lit(1).cast("long") + F.call_function("div", above, below)


class Forest:
    """Hash-consed segment trees over the same term ids, one for each row of ``counts``.

    ``counts`` is groups x terms.  Level 0 holds the leaves; each level numbers its distinct nodes
    once for all trees, by their pair of children.
    """

    def __init__(self, counts: np.ndarray):
        groups, terms = counts.shape
        size = 1 << max(terms - 1, 0).bit_length()
        self.values, leaf = np.unique(counts, return_inverse=True)
        # Leaves beyond the last term are absent and cost nothing.
        nodes = np.full((groups, size), _ABSENT, np.int64)
        nodes[:, :terms] = leaf.reshape(groups, terms) + 1
        self.left, self.right = [], []
        while nodes.shape[1] > 1:
            width = int(nodes.max()) + 1
            known, back = np.unique(nodes[:, ::2] * width + nodes[:, 1::2], return_inverse=True)
            self.left.append(known // width)
            self.right.append(known % width)
            nodes = back.reshape(groups, -1)
        self.roots = nodes[:, 0] if nodes.size else np.zeros(groups, np.int64)

    def price(self, a: np.ndarray, b: np.ndarray, prices: np.ndarray) -> np.ndarray:
        """Sum over the terms of the price differences of the trees ``a`` and ``b``, pair by pair.

        ``prices`` is groups x distinct counts.  Both trees of every pair are walked at once, level by
        level; node pairs that a pair of trees meets several times are kept once with their number.
        """
        pair, u, v = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), np.int64)
        for left, right in zip(reversed(self.left), reversed(self.right)):
            pair = np.concatenate([pair, pair])
            u, v = np.concatenate([left[u], right[u]]), np.concatenate([left[v], right[v]])
            width = int(max(u.max(initial=0), v.max(initial=0))) + 1
            met, back = np.unique((pair * width + u) * width + v, return_inverse=True)
            merged = np.zeros(len(met), np.int64)
            np.add.at(merged, back, np.concatenate([times, times]))
            times, v, rest = merged, met % width, met // width
            pair, u = rest // width, rest % width
        # A leaf is absent in both trees or in neither.
        real = u != _ABSENT
        pair, u, v, times = pair[real], u[real] - 1, v[real] - 1, times[real]
        total = np.zeros(len(a), np.int64)
        np.add.at(total, pair, np.abs(prices[a[pair], u] - prices[b[pair], v]) * times)
        return total


def price_table(values: np.ndarray, below: list[int]) -> np.ndarray:
    """The estimate of every count in every group, exactly; a group with nothing below has no terms."""
    counts = [SCALE * (int(v) + SMOOTHING) for v in values]
    return np.array([[1 + c // d for c in counts] if d else [0] * len(counts) for d in map(int, below)], np.int64).reshape(
        len(below), len(counts)
    )


def _price_tiles(key: tuple, table: pa.Table) -> pa.Table:
    low, high = key[2].as_py(), key[3].as_py()
    lang, sources = key[0].as_py(), table["source"].to_pylist()
    tile = table["tile"].to_numpy()
    terms = table["n_terms"][0].as_py() or 0
    counts = np.zeros((len(sources), terms), np.int64)
    places = table["places"].combine_chunks()
    lengths = pc.list_value_length(places).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sources)), lengths)
    counts[row, places.flatten().to_numpy()] = table["counts"].combine_chunks().flatten().to_numpy()
    a, b = np.nonzero((tile[:, None] == low) & (tile[None, :] == high))
    # A pair has the same first source in every block.
    place = np.empty(len(sources), np.int64)
    place[sorted(range(len(sources)), key=sources.__getitem__)] = np.arange(len(sources))
    if low == high:
        a, b = a[place[a] < place[b]], b[place[a] < place[b]]
    else:
        a, b = np.where(place[a] < place[b], a, b), np.where(place[a] < place[b], b, a)
    value = np.zeros(len(a), np.int64)
    if terms:
        forest = Forest(counts)
        prices = price_table(forest.values, table["below"].to_pylist())
        # So many pairs at a time as keep the merged node pairs small.
        for part in np.array_split(np.arange(len(a)), max(1, len(a) * terms >> 20)):
            value[part] = forest.price(a[part], b[part], prices)
    names = pa.array(sources, pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "one": names.take(pa.array(a)),
            "other": names.take(pa.array(b)),
            "value": pa.array(value),
        }
    )


def _vocabulary(counts: DataFrame, min_docs: int) -> DataFrame:
    """Kept terms with their ``total`` and place: ``block``, ``place`` and the block's ``n_terms``."""
    kept = (
        counts.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    return store(kept, "kept-terms")


def _langs(groups: DataFrame, kept: DataFrame, block_terms: int, tile_sources: int) -> DataFrame:
    """Per language: kept terms ``n_kept``, count of all kept terms ``lang_n``, blocks and tiles."""
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("total").alias("lang_n"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    zero = F.lit(0).cast("long")
    both = sources.join(sizes, "lang", "left").withColumns(
        {"n_kept": F.coalesce("n_kept", zero), "lang_n": F.coalesce("lang_n", zero)}
    )
    return both.select(
        "lang",
        "n_kept",
        "lang_n",
        F.greatest(F.lit(1), F.ceil(F.col("n_kept") / block_terms)).cast("int").alias("blocks"),
        F.ceil(F.col("n_sources") / tile_sources).cast("int").alias("tiles"),
    )


def _below(n: Column, kept: Column) -> Column:
    return n.cast("decimal(20,0)") + F.lit(SMOOTHING).cast("decimal(2,0)") * kept.cast("decimal(20,0)")


def divergence(
    docs: DataFrame,
    min_docs: int = 30,
    top_terms: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    block_terms: int = BLOCK_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every group.

    Part ``pair`` has every other source of the language with the summed difference of all kept
    terms; part ``term`` has the ``top_terms`` terms that the group uses most above its language.
    A term is kept in a language if at least ``min_docs`` of its documents have it.
    """
    counts = store(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = _vocabulary(counts, min_docs)
    groups = counts.where("term = ''").select("lang", "source")
    langs = store(_langs(groups, kept, block_terms, tile_sources), "langs")
    wide = attach(kept, langs, ["lang"], "inner").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    in_block = Window.partitionBy("lang", "block")
    placed = wide.select(
        "lang",
        "term",
        "total",
        "lang_n",
        "n_kept",
        "block",
        (F.row_number().over(in_block.orderBy(F.desc("total"), "term")) - 1).alias("place"),
        F.count("*").over(in_block).cast("int").alias("n_terms"),
    )
    used = store(attach(counts.where("term <> ''").drop("docs"), placed, ["lang", "term"], "inner"), "used-terms")
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    known = attach(attach(groups, langs, ["lang"], "inner"), sums, ["lang", "source"]).withColumns(
        {
            "below": _below(F.coalesce("group_n", F.lit(0).cast("long")), F.col("n_kept")),
            "tile": F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"),
        }
    )
    known = store(known, "groups")
    return _pairs(used, known).unionByName(_terms(used, known, top_terms))


def _pairs(used: DataFrame, known: DataFrame) -> DataFrame:
    """Part ``pair``: the trees of every block and two tiles, then the sum over the blocks."""
    # A row for each group and block, so that a group without counts in a block has its zero tree.
    empty = known.select(
        "lang", "source", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("struct<place:int,n:bigint>").alias("entry"), F.lit(None).cast("int").alias("n_terms"),
    )
    filled = used.select("lang", "source", "block", F.struct("place", "n").alias("entry"), "n_terms")
    trees = filled.unionByName(empty).groupBy("lang", "source", "block").agg(F.collect_list("entry").alias("entries"))
    sizes = used.groupBy("lang", "block").agg(F.max("n_terms").alias("n_terms"))
    trees = attach(trees, known.select("lang", "source", "tile", "tiles", "below"), ["lang", "source"], "inner")
    trees = attach(trees, sizes, ["lang", "block"])
    dealt = trees.select(
        "lang", "block", "source", "tile", F.col("below").cast("string").alias("below"), "n_terms",
        F.col("entries.place").alias("places"), F.col("entries.n").alias("counts"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("with"),
    ).select("*", F.least("tile", "with").alias("low"), F.greatest("tile", "with").alias("high"))
    priced = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        _price_tiles, "lang string, one string, other string, value bigint"
    )
    summed = store(priced.groupBy("lang", "one", "other").agg(F.sum("value").alias("value")), "source-pairs")
    both = summed.select("lang", F.col("one").alias("source"), F.col("other").alias("item"), "value").union(
        summed.select("lang", "other", "one", "value")
    )
    return _ranked(both, "pair", None)


def _terms(used: DataFrame, known: DataFrame, top_terms: int) -> DataFrame:
    own = attach(used, known.select("lang", "source", "below"), ["lang", "source"], "inner")
    over = estimate(F.col("n"), F.col("below")) - estimate(F.col("total"), _below(F.col("lang_n"), F.col("n_kept")))
    found = own.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")
    return _ranked(found, "term", top_terms)


def _ranked(found: DataFrame, part: str, most: int | None) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = found.withColumn("rank", rank)
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
