"""Parents by rank level: records of one depth join nodes of that depth.

The levels exclude one another, so all of them are one join on (level, names)
instead of a join per level, and the authority table is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import literal, quote, quoted
from rankmatch.functions.ranks import mask_sql
from rankmatch.operators.joins import Join, lookup
from rankmatch.settings import Level

# Name of the column that holds the level of a record or node and its names there, as one
# struct: a single key keeps the filters that Spark derives from the join small.
LEVEL_KEY = "level_key"

def rank_backbone(
    df: DataFrame,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    ranks: Sequence[str] = S.RANKS,
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """Accepted, ranked nodes of the kingdoms: id, rank and rank columns, absent as null."""
    return df.where(
        (quoted(S.STATUS) == "accepted")
        & (quoted(S.NODE_RANK) != "unranked")
        & quoted("kingdom").isin(*kingdoms)
    ).select(quoted(node_id), quoted(S.NODE_RANK), *map(quote, ranks))


def _key_sql(level: Level, extra: Sequence[str]) -> str:
    names = ", ".join(quote(c) for c in (*level.keys, *extra))
    return f"named_struct('level', {literal(level.name)}, 'names', array({names}))"


def _level_sql(levels: Sequence[Level], extra: Sequence[str]) -> str:
    """The ``level_key`` of a record: every rank is tested once, the levels then compare bits.

    A condition for each level over all ranks becomes a method the JVM does not compile.
    """
    ranks = list(dict.fromkeys(c for v in levels for c in (*v.filled, *v.blank)))
    if len(ranks) > 31:
        cases = [f"WHEN {mask_sql(v.filled, v.blank)} THEN {_key_sql(v, extra)}" for v in levels]
        return f"CASE {' '.join(cases)} END"
    # Two bits per rank, as one that is null is neither filled nor blank.
    filled, blank = ({c: 1 << (2 * i + bit) for i, c in enumerate(ranks)} for bit in (0, 1))
    bits = " + ".join(
        ["0L", *[f"CASE WHEN {quote(c)} = '' THEN {blank[c]}L WHEN {quote(c)} <> '' THEN {filled[c]}L ELSE 0L END" for c in ranks]]
    )
    cases = []
    for level in levels:
        # A rank may be named twice.
        wanted = sum({filled[c] for c in level.filled} | {blank[c] for c in level.blank})
        cases.append(f"WHEN __bits & {wanted}L = {wanted}L THEN {_key_sql(level, extra)}")
    return f"element_at(transform(array({bits}), __bits -> CASE {' '.join(cases)} END), 1)"


def record_levels(
    records: DataFrame,
    levels: Sequence[Level] = S.LEVELS,
    extra_keys: Sequence[str] = (),
    waiting: Column | None = None,
) -> DataFrame:
    """Add ``level_key``: the level of every record and its names there, null without level.

    Records for which ``waiting`` is false have no level.
    """
    key = F.expr(_level_sql(levels, extra_keys))
    return records.withColumn(LEVEL_KEY, key if waiting is None else F.when(waiting, key))


def level_columns() -> list[Column]:
    """``level_key`` as flat columns: level, name, and second name or ``''``."""
    key = F.col(LEVEL_KEY)
    second = F.coalesce(F.get(key["names"], F.lit(1)), F.lit(""))
    return [
        key["level"].alias("level"),
        F.get(key["names"], F.lit(0)).alias("level_name"),
        F.when(key.isNotNull(), second).alias("level_second"),
    ]


def node_levels(
    nodes: DataFrame,
    levels: Sequence[Level] = S.LEVELS,
    extra_keys: Sequence[str] = (),
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """One row per node and level it serves: id, ``level_key``, value of ``within``."""
    served = []
    for level in levels:
        if len(level.within) > 1:
            raise ValueError("a level can have one 'within' column")
        tests = [f"{quote(c)} IS NULL" for c in level.node_null]
        tests += [f"{quote(c)} IS NOT NULL" for c in (*level.node_filled, *level.keys, *extra_keys)]
        if level.node_rank_not is not None:
            tests.append(f"{quote(S.NODE_RANK)} <> {literal(level.node_rank_not)}")
        within = quote(level.within[0]) if level.within else "CAST(NULL AS STRING)"
        served.append(
            f"CASE WHEN {' AND '.join(tests)} THEN named_struct("
            f"'{LEVEL_KEY}', {_key_sql(level, extra_keys)}, 'within_value', {within}) END"
        )
    hits = F.expr(f"inline(filter(array({', '.join(served)}), s -> s IS NOT NULL))")
    return nodes.select(quote(node_id), hits)


def within_values(leveled: DataFrame, levels: Sequence[Level] = S.LEVELS) -> DataFrame | None:
    """The different values that records have in the ``within`` column of their level.

    The name at the level is kept, so that names that have found a parent can be left out.
    """
    cases = [f"WHEN {literal(v.name)} THEN {quote(v.within[0])}" for v in levels if v.within]
    if not cases:
        return None
    value = F.expr(f"CASE {LEVEL_KEY}.level {' '.join(cases)} END").alias("within_value")
    flat = leveled.select(*level_columns()[:2], value)
    return flat.where("within_value IS NOT NULL").distinct()


def keep_within(
    served: DataFrame, seen: DataFrame | None, levels: Sequence[Level] = S.LEVELS, join: Join = lookup
) -> DataFrame:
    """Drop nodes of levels with ``within`` whose value is not ``seen`` at that level.

    The value is tested on its own, not together with the level's key.
    """
    if seen is None:
        return served.drop("within_value")
    limited = F.col("level").isin(*[level.name for level in levels if level.within])
    seen = seen.select("level", "within_value").distinct().withColumn("__seen", F.lit(True))
    leveled = served.withColumn("level", F.col(LEVEL_KEY)["level"])
    found = join(leveled, seen, ["level", "within_value"])
    return found.where(~limited | F.col("__seen")).drop("within_value", "__seen", "level")


def level_parents(served: DataFrame, node_id: str = S.NODE_ID) -> DataFrame:
    """One row per level key: how many nodes it has and the smallest id."""
    return served.groupBy(LEVEL_KEY).agg(
        F.count("*").alias("n_parents"), F.min(quoted(node_id)).alias("first_parent")
    )


def count_parents(
    records: DataFrame,
    nodes: DataFrame,
    levels: Sequence[Level] = S.LEVELS,
    extra_keys: Sequence[str] = (),
    node_id: str = S.NODE_ID,
    waiting: Column | None = None,
    seen: DataFrame | None = None,
    join: Join = lookup,
    source: DataFrame | None = None,
) -> DataFrame:
    """Every record with its ``level``, ``n_parents`` and ``first_parent``.

    Nodes are aggregated per key before the join, so the work is linear however many nodes
    share a key.  Records for which ``waiting`` is false look for no parent.  ``seen`` are
    the :func:`within_values` if they are known already.  ``source`` holds the ranks of the
    records, or of more, where they are cheaper to read; hot names are counted there.  With
    :func:`attach` records that look for no parent, or surely find none, are read apart and not shuffled.
    """
    leveled = record_levels(records, levels, extra_keys, waiting)
    seen = within_values(leveled, levels) if seen is None else seen
    served = keep_within(node_levels(nodes, levels, extra_keys, node_id), seen, levels, join)
    counted = None if source is None else record_levels(source, levels, extra_keys)
    found = join(leveled, level_parents(served, node_id), [LEVEL_KEY], "left", counted, apart="filter")
    return found.select(
        *map(quote, records.columns),
        F.col(LEVEL_KEY)["level"].alias("level"),
        F.coalesce("n_parents", F.lit(0).cast("long")).alias("n_parents"),
        "first_parent",
    )


def rank_match(
    records: DataFrame,
    nodes: DataFrame,
    levels: Sequence[Level] = S.LEVELS,
    multi: str = "all",
    extra_keys: Sequence[str] = (),
    node_id: str = S.NODE_ID,
    parent_id: str = S.PARENT_ID,
    keep_level: bool = False,
    join: Join = lookup,
    pair_join: Join | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The records that find a parent at their level, with the parent's id.

    ``multi="all"`` gives one row per parent, ``"first"`` the smallest parent id only.
    ``extra_keys``, for instance the kingdom, must agree as well.  ``pair_join`` puts records and
    nodes together where a name may be hot on both sides; by default that is ``join``.  ``seen`` are
    the :func:`within_values` if the records are only some of those that count for them.
    """
    columns = [c for c in records.columns if c != parent_id]
    out = list(map(quote, [*columns, parent_id]))
    out += ["level"] if keep_level else []
    records = records.select(*map(quote, columns))
    if multi == "first":
        found = count_parents(records, nodes, levels, extra_keys, node_id, join=join)
        return found.where("n_parents > 0").withColumnRenamed("first_parent", parent_id).select(out)
    if multi != "all":
        raise ValueError(f"multi must be 'all' or 'first', not {multi!r}")
    leveled = record_levels(records, levels, extra_keys)
    served = node_levels(nodes, levels, extra_keys, node_id)
    seen = within_values(leveled, levels) if seen is None else seen
    served = keep_within(served, seen, levels, join)
    pairs = (pair_join or join)(leveled, served.withColumnRenamed(node_id, parent_id), [LEVEL_KEY], "inner")
    return pairs.withColumn("level", F.col(LEVEL_KEY)["level"]).select(out)


def unmatched_names(
    records: DataFrame, levels: Sequence[Level] = S.LEVELS
) -> DataFrame:
    """How many records wait for a parent per level and name."""
    return (
        record_levels(records, levels)
        .where(F.col(LEVEL_KEY).isNotNull())
        .groupBy(LEVEL_KEY)
        .agg(F.count("*").alias("n_records"))
        .select(*level_columns(), "n_records")
    )
