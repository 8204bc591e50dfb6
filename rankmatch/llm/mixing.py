"""Mixing sources to target weights by capped water-filling.

Sources share the words of all documents by weight.  A source that would be repeated more often
than ``max_epochs`` is clamped there, and its excess goes to the others by weight, until none is
above.  Every document is taken as often as the target divided by its source's size has whole
epochs.  For the rest of an epoch, documents are taken in the order of a seeded hash; of the one
across the mark only the words up to it are, so each source meets its target to the word.
Rows that share the mark, copies of one row, are numbered by the task that reads them and their
place there; the words up to the mark go to the first of them.

The mark is found by counting: sizes are summed by the leading bits of the hash, then by the
next bits within the one interval that holds the mark, then by the hash itself.  So a source
with a third of all rows is never sorted and never in one task.

Defined results: a null or empty text has size 0 and is repeated like its source; a null source is a source of its own, last in
order; a null or repeated id is a document like any other; equal rows have equal hashes, and where the
mark falls on them, so many are taken once more as the target has words left, and of one more the rest:
which of the equal rows makes no difference.  Very long texts are counted, and cut, one at a time; an
empty table gives an empty result.  Other columns only pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rankmatch.llm.common import WORD, column, free_name
from rankmatch.operators.joins import attach_stored
from rankmatch.session import store

# A table of sources is broadcast up to this number of them; beyond, it is joined by shuffle, sources
# of many rows spread over several tasks.
BROADCAST_SOURCES = 50_000
_LEVEL = 12
BLANKS = r"[\x20\x09-\x0D]*"


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mark(seed: int, *columns: Column) -> Column:
    """A seeded 63-bit number of a row."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def source_key(source: Column) -> Column:
    """A text that differs between any two sources, the missing one included, and is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank``, from 0, by code point of ``source`` with null last.

    Sources are dealt out by range; only the number of rows of each range reaches the driver.
    """
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    dealt = store(
        sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "sources"
    )
    before, offsets = 0, {}
    for part, n in sorted(dealt.groupBy("part").count().collect()):
        offsets[part] = before
        before += n
    if not offsets:
        return dealt.select("source", "size", F.lit(0).cast("long").alias("rank"))
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in offsets.items() for x in kv]), F.col("part").cast("long"))
    within = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return dealt.select("source", "size", (offset + within - 1).alias("rank"))


def targets(sources: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """``source``, ``source_size`` and ``target``; weights repeat in the order of the sources.

    The level of the water is found by rounds of one aggregate over the sources each.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    table = store(ranked(sources).select("source", "size", weight.alias("weight")), "weights")
    most = F.col("size") * float(max_epochs)
    level, clamped = 0.0, -1
    while True:
        full = most <= F.col("weight") * level
        whole, n, held, open_weight = table.agg(
            F.coalesce(F.sum("size"), F.lit(0)),
            F.count_if(full),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == clamped or not open_weight:
            break
        clamped, level = n if level else -1, (whole - held) / open_weight
        if not whole:
            break
    share = F.least(most, F.col("weight") * level)
    return table.select("source", F.col("size").alias("source_size"), share.alias("target"))


def _crossing(sums: DataFrame, digit: str) -> DataFrame:
    """Of each source, the first ``digit`` up to which the sizes exceed what is wanted, and what is left for it."""
    upto = F.sum("size").over(W.partitionBy("id").orderBy(digit))
    return (
        sums.withColumn("upto", upto)
        .where("upto > wanted")
        .groupBy("id")
        .agg(
            F.min(F.struct(digit, (F.col("wanted") - F.col("upto") + F.col("size")).alias("left"))).alias("at")
        )
        .select("id", f"at.{digit}", F.col("at.left").alias("wanted"))
    )


def plan(narrow: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: float = 3) -> DataFrame:
    """One row per source: ``source_size``, ``target``, ``epochs``, ``cut``, ``part_mark``, ``part_words``, ``part_rows``.

    ``narrow`` has ``source``, ``size`` and ``mark`` of every document.  A document is taken
    ``epochs`` times, once more if its mark is at most ``cut``, and of the ``part_rows`` documents
    whose mark is ``part_mark``, ``part_words`` words are taken once more.
    """
    sources = narrow.groupBy("source").agg(F.sum("size").alias("size"))
    share = targets(sources, weights, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A target that rounding puts just above the clamp is no further epoch.
    epochs = F.least(F.floor(ratio + 1e-12), F.lit(int(max_epochs))).cast("long")
    wanted = F.greatest(F.col("target") - epochs * F.col("source_size"), F.lit(0.0))
    share = store(
        share.select(
            "source", "source_size", "target", epochs.alias("epochs"), wanted.alias("wanted"),
            source_key(F.col("source")).alias("id"),
        ),
        "targets",
    )
    rows = narrow.select(
        source_key(F.col("source")).alias("id"),
        "size",
        "mark",
        F.shiftright("mark", 63 - _LEVEL).alias("high"),
        F.shiftright("mark", 63 - 2 * _LEVEL).bitwiseAND((1 << _LEVEL) - 1).alias("low"),
    )
    few = share.count() <= BROADCAST_SOURCES
    hint = F.broadcast if few else (lambda df: df)
    wide = rows.groupBy("id", "high").agg(F.sum("size").alias("size"))
    first = _crossing(wide.join(hint(share.select("id", "wanted")), "id"), "high")
    inner = rows.join(hint(first), ["id", "high"]).groupBy("id", "low").agg(
        F.sum("size").alias("size"), F.first("wanted").alias("wanted"), F.first("high").alias("high")
    )
    second = _crossing(inner, "low").join(hint(first.select("id", "high")), "id")
    last = rows.join(hint(second), ["id", "high", "low"]).groupBy("id", "mark").agg(
        F.sum("size").alias("size"), F.count("*").alias("rows"), F.first("wanted").alias("wanted"),
        F.first("high").alias("high"), F.first("low").alias("low"),
    )
    upto = F.sum("size").over(W.partitionBy("id").orderBy("mark"))
    begin = F.shiftleft("high", 63 - _LEVEL) + F.shiftleft("low", 63 - 2 * _LEVEL)
    under = F.col("upto") <= F.col("wanted")
    left = F.floor(F.col("wanted") - F.col("upto") + F.col("size") + 0.5)
    cuts = (
        last.withColumn("upto", upto)
        .groupBy("id")
        .agg(
            F.coalesce(F.max(F.when(under, F.col("mark"))), F.min(begin) - 1).alias("cut"),
            F.min(F.when(~under, F.struct("mark", left.alias("left"), "rows"))).alias("part"),
        )
    )
    found = share.join(hint(cuts), "id", "left")
    return store(
        found.select(
            "source", "source_size", "target", "epochs",
            F.coalesce("cut", F.lit(-1).cast("long")).alias("cut"),
            F.coalesce("part.mark", F.lit(-1).cast("long")).alias("part_mark"),
            F.coalesce("part.left", F.lit(0).cast("long")).alias("part_words"),
            F.coalesce("part.rows", F.lit(0).cast("long")).alias("part_rows"),
        ),
        "plan",
    )


def _with_plan(rows: DataFrame, source: Column, made: DataFrame) -> DataFrame:
    """Join the plan, whose first column is the source, to ``rows``.

    Every row has a source of the plan, so an outer join loses and adds none.
    """
    own = column(made.columns[0])
    if made.count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(made), source.eqNullSafe(own))
    key = free_name([*rows.columns, *made.columns], "__source")
    left, table = rows.withColumn(key, source_key(source)), made.withColumn(key, source_key(own))
    return attach_stored(left, table, [key], "left", left.select(column(key)), limit=0).drop(key)


def _numbered(rows: DataFrame, source: str, size: str, left: str, extra: str) -> DataFrame:
    """Rows that share their source's mark, with the words ``extra`` that are taken of each.

    The ``left`` words of a source go to its rows one after the other, in the order of the tasks that
    read them and of their places there, so the sums need no task but the rows' own.  The numbers are
    stored with the rows: a task that is run again meets the same ones.
    """
    task, place, before, within = (free_name(rows.columns, f"__{c}") for c in ("task", "place", "before", "within"))
    number = {task: F.spark_partition_id(), place: F.monotonically_increasing_id()}
    held = store(rows.withColumns(number), "same-mark")
    up_to = (W.unboundedPreceding, -1)
    sums = held.groupBy(column(source).alias("of"), column(task).alias("in_task")).agg(F.sum(column(size)).alias("words"))
    sums = sums.select("of", "in_task", F.sum("words").over(W.partitionBy("of").orderBy("in_task").rowsBetween(*up_to)).alias(before))
    inner = F.sum(column(size)).over(W.partitionBy(column(source), column(task)).orderBy(column(place)).rowsBetween(*up_to))
    same = column(source).eqNullSafe(F.col("of")) & (column(task) == F.col("in_task"))
    joined = held.withColumn(within, inner).join(sums, same)
    zero = F.lit(0).cast("long")
    rest = column(left) - F.coalesce(column(before), zero) - F.coalesce(column(within), zero)
    words_of = F.greatest(zero, F.least(column(size), rest))
    return joined.select(*[column(c) for c in rows.columns], words_of.alias(extra))


def amounts(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_epochs: float = 3,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes, of every row."""
    text = column(text_col).cast("string")
    narrow = store(
        docs.select(
            column(id_col).alias("doc_id"),
            column(source_col).cast("string").alias("source"),
            words(text).alias("size"),
            mark(seed, column(id_col), text).alias("mark"),
        ),
        "narrow",
    )
    made = plan(narrow, weights, max_epochs)
    at_mark = F.col("mark") == F.col("part_mark")
    whole = F.col("size") * (F.col("epochs") + (F.col("mark") <= F.col("cut")).cast("long"))
    wide = _with_plan(narrow.withColumnRenamed("source", "own"), F.col("own"), made)
    result = ["doc_id", "size", "source_size", "target"]
    part = F.when(at_mark, F.col("part_words")).otherwise(0)
    several = at_mark & (F.col("part_rows") > 1)
    taken = wide.where(~several).select(*result, (whole + part).alias("taken"))
    if made.where("part_rows > 1").isEmpty():
        return taken
    shared = _numbered(wide.where(several), "own", "size", "part_words", "extra")
    return taken.union(shared.select(*result, (whole + F.col("extra")).alias("taken")))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_epochs: float = 3,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    The row across a source's mark comes once more, cut behind the last of its words that are taken;
    ``chars_col``, if there is one, is counted anew for it.
    """
    text, source = column(text_col).cast("string"), column(source_col).cast("string")
    marked = mark(seed, column(id_col), text)
    narrow = store(docs.select(source.alias("source"), words(text).alias("size"), marked.alias("mark")), "narrow")
    made = plan(narrow, weights, max_epochs)
    names: dict[str, str] = {}
    for c in made.columns:
        names[c] = free_name([*docs.columns, *names.values()], f"__{c}")
    made = made.withColumnsRenamed(names)
    own = {c: column(name) for c, name in names.items()}
    part = free_name([*docs.columns, *made.columns], "__part")
    size, extra = (free_name([*docs.columns, *made.columns, part], f"__{c}") for c in ("size", "extra"))
    wide = _with_plan(docs, source, made)
    at_mark = marked == own["part_mark"]
    several = at_mark & (own["part_rows"] > 1)
    rest = wide.where(~several).withColumn(extra, F.when(at_mark, own["part_words"]).otherwise(F.lit(0).cast("long")))
    rest = rest.withColumn(size, F.lit(None).cast("long"))
    if not made.where(own["part_rows"] > 1).isEmpty():
        same = wide.where(several).withColumn(size, words(text))
        shared = _numbered(same, names["source"], size, names["part_words"], extra)
        rest = rest.unionByName(shared.select([column(c) for c in rest.columns]))
    # A row taken whole is a copy, not a cut.
    full = column(extra) == column(size)
    times = (own["epochs"] + (marked <= own["cut"]).cast("long") + F.coalesce(full, F.lit(False)).cast("long")).cast("int")
    cut = (column(extra) > 0) & ~F.coalesce(full, F.lit(False))
    copies = F.concat(F.array_repeat(F.lit(False), times), F.array_repeat(F.lit(True), cut.cast("int")))
    taken = rest.withColumn(part, F.explode(copies))
    spaced = F.regexp_extract_all(text, F.lit(BLANKS + WORD), F.lit(0))
    some = F.slice(spaced, F.lit(1), column(extra).cast("int"))
    shown = F.when(column(part), F.array_join(some, "")).otherwise(text)
    fresh = {text_col: shown}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        fresh[chars_col] = F.when(column(part), F.length(shown).cast(kind)).otherwise(column(chars_col))
    return taken.select(*[fresh.get(c, column(c)).alias(c) for c in docs.columns])
