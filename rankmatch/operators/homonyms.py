"""Names used by several accepted nodes, and the parents they give to records.

For a rank R and a shared name, the *chosen* node is the first one, in id order, whose
next finer rank is empty; the *other* node is the first or, when that is the chosen one,
the second.  A record is assigned through its lowest rank and its name there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import null_as_blank, quote, quoted
from rankmatch.functions.ranks import lowest_name, lowest_rank
from rankmatch.operators.joins import Join, keep_keys, lookup, repeated_keys


def accepted_names(
    backbone: DataFrame,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    ranks: Sequence[str] = S.RANKS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """Named accepted nodes of the kingdoms: id, name and ranks, absent ranks as ``''``."""
    return backbone.where(
        (quoted(S.STATUS) == "accepted")
        & quoted("kingdom").isin(*kingdoms)
        & (quoted(name) != "")
    ).select(quoted(node_id), quoted(name), *[null_as_blank(quoted(r)).alias(r) for r in ranks])


def homonym_groups(names: DataFrame, name: str = S.CANONICAL, join: Join = lookup) -> DataFrame:
    """The nodes whose name is used by at least two nodes of ``names``."""
    return keep_keys(names, repeated_keys(names, [name]), [name], join)


def _uses(ranks: Sequence[str], name: str) -> list[Column]:
    """Per rank, whether some node of a name has the name at that rank."""
    return [F.max(quoted(r) == quoted(name)).alias(f"__at_{r}") for r in ranks]


def homonym_features(
    names: DataFrame, ranks: Sequence[str] = S.RANKS, name: str = S.CANONICAL
) -> DataFrame:
    """Shared names with the ranks they occur at, finest first, as text and as array.

    Names that occur at no rank are left out.
    """
    found = names.groupBy(quoted(name)).agg(F.count("*").alias("n_nodes"), *_uses(ranks, name))
    at = [F.when(quoted(f"__at_{r}"), F.lit(r)) for r in ranks]
    return (
        found.where("n_nodes > 1")
        .select(quoted(name), F.concat_ws(", ", *at).alias("features_text"))
        .where("features_text <> ''")
        .withColumn("features", F.split("features_text", ", "))
    )


def first_two(names: DataFrame, name: str = S.CANONICAL, node_id: str = S.NODE_ID) -> DataFrame:
    """The two smallest node ids of every name.

    Spark cuts each name to two rows per task before the shuffle, so a name with very many
    nodes does not meet in one task.
    """
    place = F.row_number().over(Window.partitionBy(quoted(name)).orderBy(quoted(node_id)))
    ids = names.select(quoted(name), quoted(node_id)).withColumn("__place", place).where("__place <= 2")
    return ids.groupBy(quoted(name)).agg(
        F.min(quoted(node_id)).alias("first_id"),
        F.max(F.when(F.col("__place") == 2, quoted(node_id))).alias("second_id"),
    )


def homonym_table(
    names: DataFrame,
    ranks: Sequence[str] = S.RANKS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """One row per usable shared name: its first two nodes and the chosen node per rank.

    The column ``chosen_<rank>`` is null where no node qualifies.  The finest rank has no
    finer one that could be empty, so it never has a chosen node.
    """
    chosen = [
        F.min(F.when(quoted(finer) == "", quoted(node_id))).alias(f"chosen_{rank}")
        for finer, rank in zip(ranks, ranks[1:])
    ]
    found = names.groupBy(quoted(name)).agg(F.count("*").alias("n_nodes"), *chosen, *_uses(ranks, name))
    usable = F.greatest(*[quoted(f"__at_{r}") for r in ranks])
    return (
        found.where((F.col("n_nodes") > 1) & usable)
        .drop(*[f"__at_{r}" for r in ranks])
        .join(first_two(names, name, node_id), name)
    )


def homonym_picks(
    table: DataFrame, ranks: Sequence[str] = S.RANKS, name: str = S.CANONICAL
) -> DataFrame:
    """Long form of :func:`homonym_table`: name, rank, chosen and other node."""
    long = table.unpivot(
        [quoted(name), F.col("first_id"), F.col("second_id")],
        [quoted(f"chosen_{r}") for r in ranks[1:]],
        "rank",
        "chosen_id",
    )
    return long.where("chosen_id IS NOT NULL").select(
        quoted(name),
        F.expr(f"substring(rank, {len('chosen_') + 1})").alias("rank"),
        "chosen_id",
        F.when(F.col("chosen_id") == F.col("first_id"), F.col("second_id"))
        .otherwise(F.col("first_id"))
        .alias("other_id"),
    )


def with_target(records: DataFrame, ranks: Sequence[str] = S.RANKS) -> DataFrame:
    """Add ``lowest_rank`` and ``lowest_name``, the place a record is assigned through."""
    return records.withColumns({"lowest_rank": lowest_rank(ranks), "lowest_name": lowest_name(ranks)})


def tie_breaks(
    records: DataFrame,
    names: DataFrame,
    table: DataFrame,
    ranks: Sequence[str] = S.RANKS,
    tie_rank: str = S.TIE_RANK,
    tie_columns: Sequence[str] = S.TIE_COLUMNS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """Names for which the other node is the parent: name and ``swapped_id``.

    Only the ``tie_rank`` is looked at, and only names that are the target of exactly one
    record.  The other node wins when it equals the record in all ``tie_columns`` and the
    chosen node does not.
    """
    at_rank = with_target(records, ranks).where(F.col("lowest_rank") == tie_rank)
    at_rank = at_rank.select(
        F.col("lowest_name").alias(name), *[quoted(c).alias(f"__rec_{c}") for c in tie_columns]
    )
    # Where a name has one record, the smallest value of each column is that record's.
    lone = (
        at_rank.groupBy(quoted(name))
        .agg(F.count("*").alias("n"), *[F.min(quoted(f"__rec_{c}")).alias(f"__rec_{c}") for c in tie_columns])
        .where("n = 1")
        .drop("n")
    )
    chosen = quoted(f"chosen_{tie_rank}")
    other = F.when(chosen == F.col("first_id"), F.col("second_id")).otherwise(F.col("first_id"))
    open_names = (
        table.where(chosen.isNotNull())
        .select(quoted(name), chosen.alias("__chosen"), other.alias("__other"))
        .join(lone, name)
    )
    both = open_names.withColumn(node_id, F.explode(F.array("__chosen", "__other")))
    ranks_of = names.select(quoted(node_id), *[quoted(c).alias(f"__node_{c}") for c in tie_columns])
    equal = reduce(and_, [quoted(f"__rec_{c}") == quoted(f"__node_{c}") for c in tie_columns])
    is_other = quoted(node_id) == F.col("__other")
    return (
        both.join(ranks_of, node_id)
        .groupBy(quoted(name))
        .agg(
            F.max(F.when(~is_other, equal)).alias("chosen_equal"),
            F.max(F.when(is_other, equal)).alias("other_equal"),
            F.max("__other").alias("swapped_id"),
        )
        .where(~F.col("chosen_equal") & F.col("other_equal"))
        .select(quoted(name), "swapped_id")
    )


def parent_table(
    records: DataFrame,
    names: DataFrame,
    ranks: Sequence[str] = S.RANKS,
    tie_rank: str | None = S.TIE_RANK,
    tie_columns: Sequence[str] = S.TIE_COLUMNS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
) -> DataFrame:
    """One row per usable shared name: ``lowest_name`` and the parent per lowest rank."""
    table = homonym_table(names, ranks, name, node_id)
    parents = {f"parent_{r}": quoted(f"chosen_{r}") for r in ranks[1:]}
    if tie_rank:
        swaps = tie_breaks(records, names, table, ranks, tie_rank, tie_columns, name, node_id)
        table = table.join(swaps, name, "left")
        parents[f"parent_{tie_rank}"] = F.coalesce("swapped_id", quoted(f"chosen_{tie_rank}"))
    return table.select(
        quoted(name).alias("lowest_name"), *[c.alias(alias) for alias, c in parents.items()]
    )


def parents_by_rank(table: DataFrame, ranks: Sequence[str] = S.RANKS) -> DataFrame:
    """Long form of :func:`parent_table`: the ranks and names that give a parent."""
    pairs = F.array(
        *[
            F.when(
                quoted(f"parent_{r}").isNotNull(),
                F.struct(F.lit(r).alias("lowest_rank"), F.col("lowest_name")),
            )
            for r in ranks[1:]
        ]
    )
    return table.select(F.inline(F.filter(pairs, lambda p: p.isNotNull())))


def homonym_parents(
    records: DataFrame,
    table: DataFrame,
    ranks: Sequence[str] = S.RANKS,
    join: Join = lookup,
) -> DataFrame:
    """Every record with ``homonym_parent``, null if it has none, and ``is_homonym``.

    ``is_homonym`` with a null parent marks an unresolvable record: its name is shared,
    but no node of that name qualifies.
    """
    table = table.withColumn("is_homonym", F.lit(True))
    found = join(with_target(records, ranks), table, ["lowest_name"], "left")
    parent = F.coalesce(
        *[F.when(F.col("lowest_rank") == r, quoted(f"parent_{r}")) for r in ranks[1:]]
    )
    return found.select(
        *map(quote, records.columns),
        F.coalesce("is_homonym", F.lit(False)).alias("is_homonym"),
        parent.alias("homonym_parent"),
    )


def homonym_assign(
    records: DataFrame,
    backbone: DataFrame,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    ranks: Sequence[str] = S.RANKS,
    tie_rank: str | None = S.TIE_RANK,
    tie_columns: Sequence[str] = S.TIE_COLUMNS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
    parent_id: str = S.PARENT_ID,
    join: Join = lookup,
) -> DataFrame:
    """The records whose lowest name is shared and resolvable, with their parent."""
    names = accepted_names(backbone, kingdoms, ranks, name, node_id)
    table = parent_table(records, names, ranks, tie_rank, tie_columns, name, node_id)
    found = homonym_parents(records, table, ranks, join).where("homonym_parent IS NOT NULL")
    columns = [c for c in records.columns if c != parent_id]
    return found.select(*map(quote, columns), F.col("homonym_parent").alias(parent_id))


def unresolvable_homonyms(
    records: DataFrame,
    backbone: DataFrame,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    ranks: Sequence[str] = S.RANKS,
    name: str = S.CANONICAL,
    node_id: str = S.NODE_ID,
    join: Join = lookup,
) -> DataFrame:
    """How many records per shared name and rank have no node that qualifies."""
    names = accepted_names(backbone, kingdoms, ranks, name, node_id)
    table = parent_table(records, names, ranks, None, (), name, node_id)
    found = homonym_parents(records, table, ranks, join)
    return (
        with_target(found.where("is_homonym AND homonym_parent IS NULL"), ranks)
        .groupBy("lowest_rank", "lowest_name")
        .agg(F.count("*").alias("n_records"))
    )
