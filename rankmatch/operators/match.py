"""Exact match of records to nodes, and what is ambiguous about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import blank_as_null, null_as_blank, quote, quoted
from rankmatch.operators.clean import derive_genus, fill_blank, require
from rankmatch.operators.joins import Join, drop_keys, flag_repeated, keep_keys, lookup, split_repeated


def prepare_backbone(
    df: DataFrame,
    statuses: Sequence[str] = S.MATCHABLE_STATUSES,
    genus_from_generic: bool = False,
) -> DataFrame:
    """Nodes that may be matched exactly.

    Keeps ranked nodes of the given statuses that have a genus and a specific epithet; an
    absent infraspecific epithet becomes ``''``.  ``genus_from_generic`` takes the generic
    name where the genus is null before nodes without genus are dropped.
    """
    genus = F.coalesce("genus", "genericName") if genus_from_generic else F.col("genus")
    return (
        df.where(F.col(S.STATUS).isin(*statuses) & (F.col(S.NODE_RANK) != "unranked"))
        .withColumn("genus", genus)
        .where((F.col("genus") != "") & (F.col("specificEpithet") != ""))
        .select(
            S.NODE_ID,
            "genericName",
            "genus",
            "specificEpithet",
            null_as_blank(F.col("infraspecificEpithet")).alias("infraspecificEpithet"),
            S.STATUS,
            S.ACCEPTED_ID,
        )
    )


def exact_match(
    records: DataFrame,
    nodes: DataFrame,
    keys: Sequence[str] = S.EXACT_KEYS,
    columns: Sequence[str] | None = S.MATCH_COLUMNS,
    record_id: str = "speciesId",
    generic_name: str = "node",
    join: Join = lookup,
) -> DataFrame:
    """Every record, once per node that agrees on ``keys``, once without node if none does.

    ``generic_name`` says whose generic name is kept, the ``"node"``'s or the
    ``"record"``'s.  ``columns`` is the output order; None keeps the records' columns.
    ``''`` in the infraspecific epithet becomes null again.  Columns of ``columns`` that
    cleaning dropped as wholly empty come back as null.

    The result has one row per pair; where only unambiguous matches matter,
    :func:`candidates` gives the same answer without the pairs.
    """
    if generic_name not in ("node", "record"):
        raise ValueError(f"generic_name must be 'node' or 'record', not {generic_name!r}")
    require(records, [record_id, *keys])
    out_id = S.RECORD_ID if record_id == "speciesId" else record_id
    table = nodes.withColumnRenamed(S.NODE_ID, S.MATCHED_ID).select(
        *keys, S.MATCHED_ID, S.ACCEPTED_ID, *(["genericName"] if generic_name == "node" else [])
    )
    if generic_name == "node" and "genericName" in records.columns:
        records = records.drop("genericName")
    joined = join(records, table, keys, "left").withColumnRenamed(record_id, out_id)
    return _finish(joined, columns)


def _finish(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    if "infraspecificEpithet" in df.columns:
        df = df.withColumn("infraspecificEpithet", blank_as_null(F.col("infraspecificEpithet")))
    if columns is None:
        return df
    have = set(df.columns)
    return df.select(
        [quoted(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]
    )


def node_keys(
    nodes: DataFrame, keys: Sequence[str] = S.EXACT_KEYS, carry: Sequence[str] = ("genericName",)
) -> DataFrame:
    """One row per key: how many nodes have it, and the ids of the node if there is just one."""
    single = {S.MATCHED_ID: S.NODE_ID, S.ACCEPTED_ID: S.ACCEPTED_ID, **{c: c for c in carry}}
    counted = nodes.groupBy(*map(quote, keys)).agg(
        F.count("*").alias("n_nodes"),
        *[F.min(quoted(c)).alias(f"__{name}") for name, c in single.items()],
    )
    only = F.col("n_nodes") == 1
    return counted.select(
        *map(quote, keys),
        "n_nodes",
        *[F.when(only, quoted(f"__{name}")).alias(name) for name in single],
    )


def candidates(
    records: DataFrame,
    nodes: DataFrame,
    keys: Sequence[str] = S.EXACT_KEYS,
    columns: Sequence[str] | None = S.MATCH_COLUMNS,
    record_id: str = "speciesId",
    carry: Sequence[str] = ("genericName",),
    join: Join = lookup,
) -> DataFrame:
    """Every record once, with ``n_nodes`` that agree on ``keys`` and ``is_repeated`` of its id.

    Nodes are aggregated per key before the join, so the work is linear in both tables
    however many nodes share a key.  Ids are filled when ``n_nodes`` is 1.
    """
    require(records, [record_id, *keys])
    out_id = S.RECORD_ID if record_id == "speciesId" else record_id
    records = records.drop(*[c for c in carry if c in records.columns])
    flagged = flag_repeated(records, record_id, join=join)
    joined = join(flagged, node_keys(nodes, keys, carry), keys, "left", records, apart="null")
    joined = joined.withColumn("n_nodes", F.coalesce("n_nodes", F.lit(0).cast("long")))
    joined = joined.withColumnRenamed(record_id, out_id)
    return _finish(joined, None if columns is None else [*columns, "n_nodes", "is_repeated"])


def split_candidates(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, unmatched, ambiguous) of :func:`candidates`.

    A record is ambiguous when its id stands for more than one row of the exact match:
    several nodes, or an id that is repeated.
    """
    extra = ("n_nodes", "is_repeated")
    return (
        found.where("n_nodes = 1 AND NOT is_repeated").drop(*extra),
        found.where("n_nodes = 0 AND NOT is_repeated").drop(*extra),
        found.where("n_nodes > 1 OR is_repeated"),
    )


def resolve_ambiguous(
    matches: DataFrame,
    record_id: str = S.RECORD_ID,
    node_id: str = S.MATCHED_ID,
    accepted_id: str = S.ACCEPTED_ID,
    on_ambiguous: str = "drop",
    join: Join = lookup,
) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) rows of :func:`exact_match`.

    ``"drop"`` keeps the rows whose record id occurs once.  ``"accepted_backed"`` also
    keeps, among the others, rows whose node is accepted itself and is the accepted node
    of another such row; the remaining rows of these records are in neither output.
    """
    single, repeated = split_repeated(matches, record_id, join)
    if on_ambiguous == "drop":
        return single, repeated
    if on_ambiguous != "accepted_backed":
        raise ValueError(f"on_ambiguous must be 'drop' or 'accepted_backed', not {on_ambiguous!r}")
    backing = repeated.select(quoted(accepted_id).alias(node_id)).where(quoted(node_id).isNotNull())
    backed = keep_keys(repeated.where(quoted(accepted_id).isNull()), backing, [node_id], join)
    return single.unionByName(backed), drop_keys(repeated, backed, [record_id], join)


def backed_pairs(
    found: DataFrame,
    nodes: DataFrame,
    keys: Sequence[str] = S.EXACT_KEYS,
    generic_name: str = "node",
    join: Join = lookup,
) -> DataFrame:
    """The pairs that ``resolve_ambiguous(..., "accepted_backed")`` keeps of ambiguous records.

    ``found`` is the output of :func:`candidates`.  Only the ambiguous records are put
    together with nodes, and of those only nodes that are accepted and are the accepted node
    of another node of an ambiguous key.
    """
    _, _, ambiguous = split_candidates(found)
    refilled = ambiguous.withColumns({k: null_as_blank(quoted(k)) for k in keys if k == "infraspecificEpithet"})
    open_nodes = keep_keys(nodes, refilled.where(F.col("n_nodes") > 0), keys, join)
    backing = open_nodes.select(F.col(S.ACCEPTED_ID).alias(S.NODE_ID)).where(F.col(S.NODE_ID).isNotNull())
    backed = keep_keys(open_nodes.where(F.col(S.ACCEPTED_ID).isNull()), backing, [S.NODE_ID], join)
    carried = ["genericName"] if generic_name == "node" else []
    table = backed.select(*map(quote, keys), quoted(S.NODE_ID).alias(S.MATCHED_ID), S.ACCEPTED_ID, *carried)
    given = [c for c in (S.MATCHED_ID, S.ACCEPTED_ID, *carried) if c in refilled.columns]
    pairs = join(refilled.drop(*given), table, keys, "inner")
    return _finish(pairs, [c for c in found.columns if c not in ("n_nodes", "is_repeated")])


def accepted_backed(
    found: DataFrame,
    nodes: DataFrame,
    keys: Sequence[str] = S.EXACT_KEYS,
    join: Join = lookup,
) -> DataFrame:
    """Ambiguous records with the accepted nodes that back them, one row per record.

    Same choice as ``resolve_ambiguous(..., "accepted_backed")`` without the pairs: the
    nodes to keep are found among the nodes of ambiguous keys, counted per key, and
    looked up.  ``found`` is the output of :func:`candidates` with its ``keys``.
    """
    _, _, ambiguous = split_candidates(found)
    open_nodes = keep_keys(nodes, ambiguous.where(F.col("n_nodes") > 0), keys, join)
    backing = open_nodes.select(F.col(S.ACCEPTED_ID).alias(S.NODE_ID)).where(F.col(S.NODE_ID).isNotNull())
    backed = keep_keys(open_nodes.where(F.col(S.ACCEPTED_ID).isNull()), backing, [S.NODE_ID], join)
    per_key = backed.groupBy(*map(quote, keys)).agg(
        F.count("*").alias("n_backed"), F.min(S.NODE_ID).alias("first_backed")
    )
    return join(ambiguous, per_key, keys, "inner")


def label_unmatched(
    df: DataFrame, labels: Mapping[str, str] = S.UNMATCHED_LABELS, parent_id: str = S.PARENT_ID
) -> DataFrame:
    """Give records without node their genus, labels and an empty parent id.

    The genus is derived before nulls become ``''`` in all string columns.
    """
    return fill_blank(
        derive_genus(df).withColumns(
            {**{c: F.lit(v) for c, v in labels.items()}, parent_id: F.lit(None).cast("long")}
        )
    )


def unmatched(
    matches: DataFrame,
    node_id: str = S.MATCHED_ID,
    labels: Mapping[str, str] = S.UNMATCHED_LABELS,
) -> DataFrame:
    """The records of a match that have no node, ready for the parent search."""
    return label_unmatched(matches.where(quoted(node_id).isNull()), labels)


__all__ = [
    "accepted_backed",
    "backed_pairs",
    "candidates",
    "exact_match",
    "label_unmatched",
    "node_keys",
    "prepare_backbone",
    "resolve_ambiguous",
    "split_candidates",
    "unmatched",
]
