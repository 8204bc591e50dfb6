"""Joins that hold when one key has a third of all rows.

Operators take the join they use as an argument.  :func:`lookup` only adds to the plan;
:func:`attach` first stores and measures the looked-up table, and then broadcasts it or
spreads the hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankmatch.functions.names import quote, quoted
from rankmatch.session import store

# (left, table, keys, how, source=None, apart=None) -> joined; see lookup and attach.
Join = Callable[..., DataFrame]

# A key with fewer rows than this fits a task; one with more is spread over one part for each
# so many rows.  So there is at most one hot key for each so many rows of the table.
HOT_ROWS = 1_000_000
# A table is broadcast when its values take no more bytes than this.
BROADCAST_BYTES = 32 * 1024 * 1024

# Bits of the filter of wanted keys that goes ahead of a shuffle: 4 MB are broadcast, whatever the tables' sizes.
FILTER_BITS = 1 << 25

# Rows without a match are told from the others by a filter of at most so many bits, 32 MB.
MOST_FILTER_BITS = 1 << 28

# A word of a filter is an array of so many longs: a row for each long would take four times the filter's
# bits in the driver and in every executor.
WORD_LONGS = 64

# A task makes at most about so many pairs of one key.
CELL_PAIRS = 1_000_000

# A table with this column says itself how many rows have each key.
ROWS = "__rows"
# What a join of the kind "repeated" adds: whether several rows have the key of a row.
REPEATED = "__repeated"

_SALT = "__salt"
_PARTS = "__parts"
_ROW, _COLUMN = "__grid_row", "__grid_column"


def _any_null(keys: Sequence[str]) -> Column:
    return F.expr(" OR ".join(f"{quote(k)} IS NULL" for k in keys))


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """Every key of ``df`` with more than ``min_rows`` rows, by default :data:`HOT_ROWS`, and its ``__parts``.

    Counts are combined per task before the shuffle, or read from the column :data:`ROWS` if
    there is one.  The result has at most one row for each ``min_rows`` rows of ``df``; it only
    decides how :func:`lookup` spreads keys and never what the join returns.
    """
    size = HOT_ROWS if min_rows is None else min_rows
    counts = df.where(~_any_null(keys))
    if ROWS not in df.columns:
        counts = counts.groupBy(*map(quote, keys)).agg(F.count("*").alias(ROWS))
    parts = F.ceil(F.col(ROWS) / size).cast("long")
    return counts.where(F.col(ROWS) > size).select(*map(quote, keys), parts.alias(_PARTS))


def _spread(df: DataFrame) -> Column:
    """A number that differs between rows of one key, and is the same when a task is run again.

    It hashes the row itself, as rows that already lie by their key come from one task; the
    task's number keeps identical rows from different tasks apart.
    """
    own = [quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*own, F.spark_partition_id())


def lookup(
    left: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    source: DataFrame | None = None,
    hot: DataFrame | None = None,
    apart: str | None = None,
) -> DataFrame:
    """Join ``left`` to ``table`` on equal ``keys``; null keys match nothing.

    Meant for a ``table`` with one row per key, or few.  ``hot`` lists keys that have many
    rows in ``left`` (see :func:`hot_keys`): those rows are spread over the key's parts
    and the table's rows for these keys are repeated once per part.  In a left join the
    rows without a key are spread too, as they would otherwise all meet in one task.
    ``source`` is used by :func:`attach` only.

    ``apart`` is for an outer join of a ``left`` that is cheap to read twice: rows without a key
    are then read on their own and not shuffled (``"null"``), and :func:`attach` does so with rows
    whose key is not in the table as well (``"filter"``).

    ``how="repeated"`` adds :data:`REPEATED` to ``left``; ``table`` then has every key of ``left`` and its
    :data:`ROWS` there.
    """
    if how == "repeated":
        found = lookup(left, table.where(F.col(ROWS) > 1), keys, "left", hot=hot)
        return found.select(*[quoted(c) for c in left.columns], F.col(ROWS).isNotNull().alias(REPEATED))
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    columns = _columns(left, table, keys, how)
    outer = how in ("left", "left_anti")
    if apart and outer:
        without = left.where(_any_null(keys))
        joined = lookup(left.where(~_any_null(keys)), table, keys, how, hot=hot)
        return joined.unionByName(_unmatched_rows(without, table, keys, how))
    if hot is None and not outer:
        return left.join(table, keys, how)

    number = _spread(left)
    # Rows without a key match nothing, so each may have a number of its own.
    cases = [F.when(_any_null(keys), number)] if outer else []
    spread = table.withColumn(_SALT, F.lit(0).cast("long"))
    if hot is not None:
        flags = F.broadcast(hot.select(*map(quote, keys), _PARTS))
        left = left.join(flags, keys, "left")
        cases.append(F.when(F.col(_PARTS).isNotNull(), F.pmod(number, F.col(_PARTS))))
        last = F.coalesce(F.col(_PARTS), F.lit(1).cast("long")) - 1
        spread = table.join(flags, keys, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), last)))
        spread = spread.drop(_PARTS)
    salt = F.coalesce(*cases, F.lit(0).cast("long"))
    joined = left.withColumn(_SALT, salt).join(spread, [*keys, _SALT], how)
    return joined.select(columns)


def _width(kind: T.DataType) -> int:
    """Bytes a value takes in a row of a hash table, without the text of strings."""
    if isinstance(kind, T.StructType):
        return 16 + sum(_width(f.dataType) for f in kind.fields)
    return 8


def _text_columns(schema: T.StructType, prefix: str = "") -> list[str]:
    found = []
    for field in schema.fields:
        path = prefix + quote(field.name)
        if isinstance(field.dataType, T.StructType):
            found += _text_columns(field.dataType, path + ".")
        elif not isinstance(field.dataType, T.NumericType):
            found.append(path)
    return found


def table_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take in memory: a fixed width per row, nulls included, and all text.

    One row comes to the driver.
    """
    text = [f"coalesce(octet_length(CAST({c} AS STRING)), 0)" for c in _text_columns(df.schema)]
    total = F.expr(f"coalesce(sum({' + '.join(text)}), 0)") if text else F.lit(0)
    rows, texts = df.agg(F.count("*"), total).first()
    return rows * (32 + sum(_width(f.dataType) for f in df.schema.fields)) + texts


def _bit(keys: Sequence[str], bits: int | None, seed: int) -> Column:
    hashed = F.xxhash64(*map(quote, keys), *([F.lit(seed)] if seed else []))
    return F.pmod(hashed, F.lit(FILTER_BITS if bits is None else bits).cast("long"))


def key_filter(table: DataFrame, keys: Sequence[str], bits: int | None = None, seed: int = 0) -> DataFrame:
    """A Bloom filter of the keys of ``table``: ``__word`` and its ``__bits``, an array of :data:`WORD_LONGS` longs.

    Every key sets one of ``bits`` bits, by its hash.  Bits are gathered per long and combined per task
    before the shuffle, and longs per word, so the result has at most a row for each word.  Filters of another
    ``seed`` use another hash, so keys that share a bit in one hardly ever do in both.
    """
    at = _bit(keys, bits, seed)
    one = F.expr("shiftleft(1L, cast(pmod(__at, 64) as int))")
    longs = table.where(~_any_null(keys)).select(at.alias("__at")).select(F.expr("__at div 64").alias("__long"), one.alias("__bit"))
    longs = longs.groupBy("__long").agg(F.bit_or("__bit").alias("__bits"))
    entry = F.struct(F.expr(f"cast(pmod(__long, {WORD_LONGS}) as int)"), "__bits")
    words = longs.groupBy(F.expr(f"__long div {WORD_LONGS}").alias("__word")).agg(F.map_from_entries(F.collect_list(entry)).alias("__longs"))
    # The map is bound by a lambda, as it would else be made again for each long.
    filled = f"transform(sequence(0, {WORD_LONGS - 1}), i -> coalesce(try_element_at(m, i), 0L))"
    return words.select("__word", F.expr(f"element_at(transform(array(__longs), m -> {filled}), 1)").alias("__bits"))


def _set_bits(words: DataFrame) -> int:
    """How many bits of a :func:`key_filter` are set."""
    return words.agg(F.expr("coalesce(sum(aggregate(__bits, 0L, (n, b) -> n + bit_count(b))), 0L)")).first()[0]


def _looked_up(left: DataFrame, words: DataFrame, keys: Sequence[str], bits: int | None, seed: int, how: str) -> tuple[DataFrame, Column]:
    """``left`` with the word of each row, and whether the bit of its key is set there."""
    at = left.withColumn("__at", _bit(keys, bits, seed)).withColumn("__word", F.expr(f"__at div {64 * WORD_LONGS}"))
    # Spark adds these conditions in some joins only, and would broadcast a filter that is used in several kinds again.
    found = at.join(F.broadcast(words.where("__word IS NOT NULL AND __bits IS NOT NULL")), "__word", how)
    return found, F.expr(f"shiftrightunsigned(get(__bits, cast(pmod(__at div 64, {WORD_LONGS}) as int)), cast(pmod(__at, 64) as int)) & 1L = 1L")


def maybe_in(left: DataFrame, words: DataFrame, keys: Sequence[str], bits: int | None = None, seed: int = 0) -> DataFrame:
    """The rows of ``left`` whose key may be in ``words``, those of :func:`key_filter`; no key in it is missed."""
    found, hit = _looked_up(left, words, keys, bits, seed, "inner")
    return found.where(hit).select([quoted(c) for c in left.columns])


def _reduced(left: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` without most rows that a join to ``table`` drops anyway, ahead of its shuffle.

    A filter with over half of its bits set would let most rows pass, so then none is applied.
    """
    words = store(key_filter(table, keys), "key-filter")
    return maybe_in(left, words, keys) if 2 * _set_bits(words) <= FILTER_BITS else left


def _unmatched_rows(left: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """What an outer join gives for rows that match nothing."""
    if how == "left_anti":
        return left
    return left.withColumns({f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in keys})


def _own_filter(table: DataFrame, keys: Sequence[str], seed: int = 0) -> tuple[DataFrame, int] | None:
    """The stored :func:`key_filter` of ``table`` and its bits: four or more for each key, at most :data:`MOST_FILTER_BITS`.

    None if over half of them are set, as most rows would pass.
    """
    bits = FILTER_BITS
    while bits < min(4 * table.count(), MOST_FILTER_BITS):
        bits *= 2
    words = store(key_filter(table, keys, bits, seed), "key-filter")
    return None if 2 * _set_bits(words) > bits else (words, bits)


def _tested(left: DataFrame, words: DataFrame, keys: Sequence[str], bits: int, name: str, seed: int = 0) -> DataFrame:
    """``left`` with the boolean ``name``: whether a row's key may be in ``words``; false without a key."""
    found, hit = _looked_up(left, words, keys, bits, seed, "left")
    return found.select(*[quoted(c) for c in left.columns], (F.coalesce(hit, F.lit(False)) & ~_any_null(keys)).alias(name))


def _apart(left: DataFrame, table: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """The rows of ``left`` whose key may be in ``table``, and those whose key is not; None if too many pass."""
    own = _own_filter(table, keys)
    if own is None:
        return None
    tested = _tested(left, own[0], keys, own[1], "__maybe")
    return tested.where("__maybe").drop("__maybe"), tested.where("NOT __maybe").drop("__maybe")


def _mark_repeated(left: DataFrame, counted: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """``left`` with :data:`REPEATED`; ``counted`` is stored and has every key of ``left`` with its :data:`ROWS`.

    A first filter has the repeated keys, a second one those keys that occur once and pass the first.
    A row that does not pass the first is not repeated; one that passes it and not the second is.
    Only rows that pass both are shuffled, and only to repeated keys that pass the second.
    """
    keys, columns = list(keys), [quoted(c) for c in left.columns]
    flag = F.col(ROWS).isNotNull().alias(REPEATED)
    twice, once = counted.where(F.col(ROWS) > 1), counted.where(F.col(ROWS) == 1)
    if table_bytes(twice) <= limit:
        return left.join(F.broadcast(twice), keys, "left").select(*columns, flag)
    hot, first = _hot_list(twice, keys), _own_filter(twice, keys)
    if first is None:
        return lookup(left, counted, keys, "repeated", hot=hot)
    tested, unsure, sure = _tested(left, first[0], keys, first[1], "__maybe"), "__maybe", F.lit(False)
    second = _own_filter(maybe_in(once, first[0], keys, first[1]), keys, seed=1)
    if second is not None:
        tested = _tested(tested, second[0], keys, second[1], "__second", seed=1)
        unsure, sure = "__maybe AND __second", F.col("__maybe")
        twice = maybe_in(twice, second[0], keys, second[1], seed=1)
    decided = tested.where(f"NOT ({unsure})").select(*columns, sure.alias(REPEATED))
    return lookup(tested.where(unsure).select(columns), twice, keys, "left", hot=hot).select(*columns, flag).unionByName(decided)


def attach_stored(
    left: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    source: DataFrame | None = None,
    limit: int | None = None,
    apart: str | None = None,
) -> DataFrame:
    """:func:`lookup` in a stored table, choosing how to join by its measured size.

    Up to :data:`BROADCAST_BYTES` the table is broadcast and ``left`` is not shuffled at
    all; beyond that (or ``limit``) both sides are shuffled and the hot keys of ``left`` are spread.
    A join that drops rows of ``left`` then first drops most of them by a :func:`key_filter`.
    They are counted in ``source`` if it is given: rows that have the keys of ``left``, or
    more, and are cheaper to compute.  A table with the column :data:`ROWS` knows them.
    ``apart`` and ``"repeated"`` are those of :func:`lookup`.
    """
    if how == "repeated":
        return _mark_repeated(left, table, keys, BROADCAST_BYTES if limit is None else limit)
    if ROWS in table.columns:
        source = table
    if table_bytes(table) <= (BROADCAST_BYTES if limit is None else limit):
        columns = _columns(left, table, keys, how)
        return left.join(F.broadcast(table), list(keys), how).select(columns)
    if how in ("inner", "left_semi"):
        left = _reduced(left, table, keys)
    hot = _hot_list(left if source is None else source, keys)
    parted = _apart(left, table, keys) if apart == "filter" and how in ("left", "left_anti") else None
    if parted is None:
        return lookup(left, table, keys, how, hot=hot, apart=apart)
    maybe, without = parted
    return lookup(maybe, table, keys, how, hot=hot).unionByName(_unmatched_rows(without, table, keys, how))


def _hot_list(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The :func:`hot_keys` of ``df`` that fit a broadcast: where they do not, those of the most rows.

    Keys with at least p parts are at most a p-th of all, so a few doublings of p suffice; a key left out
    has fewer rows than any that is spread.
    """
    hot, parts = store(hot_keys(df, keys), "hot"), 1
    while table_bytes(hot.where(F.col(_PARTS) >= parts)) > BROADCAST_BYTES:
        parts *= 2
    return hot.where(F.col(_PARTS) >= parts)


def attach(
    left: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    source: DataFrame | None = None,
    base: str | None = None,
    limit: int | None = None,
    apart: str | None = None,
) -> DataFrame:
    """:func:`attach_stored`, writing the table to the shared folder, or to ``base``, first."""
    return attach_stored(left, store(table, "lookup", base), keys, how, source, limit, apart)


def grid(left: DataFrame, table: DataFrame, keys: Sequence[str], cell_pairs: int | None = None) -> DataFrame:
    """Every key with more than ``cell_pairs`` pairs of rows, and the grid its pairs are cut into.

    The left rows of such a key go to ``__grid_row`` rows of cells and its table rows to
    ``__grid_column`` columns.  Both follow from both counts, so that a cell has about ``cell_pairs``
    pairs at most and as few rows as possible are repeated: each left row once per column, each table
    row once per row.  Counts are combined per task before the shuffle.
    """
    most = CELL_PAIRS if cell_pairs is None else cell_pairs

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.where(~_any_null(keys)).groupBy(*map(quote, keys)).agg(F.count("*").cast("double").alias(name))

    both = counted(left, "__n").join(counted(table, "__m"), list(keys))
    cells = F.ceil(F.col("__n") * F.col("__m") / most).cast("double")
    rows = F.least(F.col("__n"), cells, F.greatest(F.lit(1.0), F.ceil(F.sqrt(cells * F.col("__n") / F.col("__m"))).cast("double")))
    return both.where(F.col("__n") * F.col("__m") > most).select(
        *map(quote, keys), rows.cast("long").alias(_ROW), F.ceil(cells / rows).cast("long").alias(_COLUMN)
    )


def attach_pairs(
    left: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    source: DataFrame | None = None,
    base: str | None = None,
    cell_pairs: int | None = None,
) -> DataFrame:
    """Join ``left`` to a ``table`` with many rows per key, of which some may be hot on both sides.

    The pairs of a hot key are a grid of cells, each cell a task's work: no task makes more than
    about ``cell_pairs`` pairs of one key, however its rows are dealt to the two sides.  Without
    such a key this is :func:`attach`.  The list of hot keys is broadcast if it is small, else
    looked up.
    """
    stored = store(table, "lookup", base)
    if how not in ("inner", "left"):
        return attach_stored(left, stored, keys, how, source)
    keys = list(keys)
    cut = store(grid(left if source is None else source, stored, keys, cell_pairs), "grid", base)
    if cut.isEmpty():
        return attach_stored(left, stored, keys, how, source)
    columns = _columns(left, stored, keys, how)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def cells(df: DataFrame, own: str, other: str, alone: Column) -> DataFrame:
        number = _spread(df)
        flagged = attach_stored(df.withColumn("__number", number), cut, keys, "left")
        mine = F.when(F.col(own).isNotNull(), F.pmod("__number", own)).otherwise(alone)
        each = F.explode(F.sequence(zero, F.coalesce(other, one) - 1))
        kept = [quoted(c) for c in df.columns]
        wide = flagged.select(*kept, mine.alias("__own"), F.col(own).isNotNull().alias("__cut"), each.alias("__other"))
        return wide.withColumnsRenamed({"__own": own, "__other": other})

    # Rows without a key match nothing, so each may lie anywhere.
    lonely = F.when(_any_null(keys), F.col("__number")).otherwise(zero)
    one_side = cells(left, _ROW, _COLUMN, lonely)
    two_side = cells(stored, _COLUMN, _ROW, zero).drop("__cut").withColumn("__met", F.lit(True))
    # A hint, as a broadcast would put all pairs of a left task into one task again.
    joined = one_side.join(two_side.hint("merge"), [*keys, _ROW, _COLUMN], how)
    # A left row of a cut key meets some cell of its row of cells; the copies that meet none are no rows.
    return joined.where(F.col("__met").isNotNull() | ~F.col("__cut")).select(columns)


def _columns(left: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> list[str]:
    extra = [c for c in table.columns if c not in keys]
    clash = [c for c in extra if c in left.columns]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    return [quote(c) for c in [*left.columns, *([] if how in ("left_semi", "left_anti") else extra)]]


def keep_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], join: Join = lookup
) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return join(left, right.select(*map(quote, keys)).distinct(), keys, "left_semi")


def drop_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], join: Join = lookup
) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; rows without a key stay."""
    return join(left, right.select(*map(quote, keys)).distinct(), keys, "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, null keys counting as equal, and their ``n_rows``."""
    return (
        df.groupBy(*map(quote, keys)).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    )


def flag_repeated(
    df: DataFrame, key: str, flag: str = "is_repeated", join: Join = lookup
) -> DataFrame:
    """Add whether several rows have the ``key`` of a row; null keys count as equal.

    The counts are joined back instead of being taken in a window: a window would hold
    all rows of a key in one task.  ``df`` should be a stored table: with :func:`attach` it is read
    twice, so that rows of which filters tell whether their key is repeated are not shuffled.
    """
    keys = {
        "__key": F.coalesce(quoted(key).cast("string"), F.lit("")),
        "__key_null": quoted(key).isNull(),
    }
    keyed = df.withColumns(keys)
    counted = keyed.groupBy(*keys).agg(F.count("*").alias(ROWS))
    # Text is shuffled once, as the join key, and not beside it.
    text = isinstance(df.schema[key].dataType, T.StringType)
    if text:
        keyed = keyed.drop(quoted(key))
    found = join(keyed, counted, list(keys), "repeated")
    if text:
        found = found.withColumn(key, F.when(~F.col("__key_null"), F.col("__key")))
    return found.select(*map(quote, df.columns), F.col(REPEATED).alias(flag))


def split_repeated(df: DataFrame, key: str, join: Join = lookup) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` occurs once, and rows whose key occurs more often."""
    flagged = flag_repeated(df, key, "__repeated", join)
    single, repeated = flagged.where("NOT __repeated"), flagged.where("__repeated")
    return single.drop("__repeated"), repeated.drop("__repeated")
