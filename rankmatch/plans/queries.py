"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import category, first_token, quote, strip_markup
from rankmatch.functions.ranks import lowest_name, lowest_rank
from rankmatch.operators import clean, homonyms, joins, levels, match, reconcile
from rankmatch.operators.joins import attach, attach_pairs
from rankmatch.plans import tables as T
from rankmatch.plans.flow import (
    Results,
    assign_parents,
    find_unmatched,
    inspect_parents,
    match_checklist,
    read_results,
    summarise,
    write_results,
)
from rankmatch.session import case_sensitive, store, working_folder
from rankmatch.sources.files import read_backbone_checked, read_records, string_schema, write_csv

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its own name."""
    QUERIES[fn.__name__] = fn
    return fn


# --- cleaning ------------------------------------------------------------------------


@query
def q_clean_trim(spark: SparkSession, sf: str) -> DataFrame:
    docs = T.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"), F.concat("source", F.lit("  ")).alias("source")
    )
    return clean.trim_strings(docs)


@query
def q_strip_markup(spark: SparkSession, sf: str) -> DataFrame:
    pages = T.table(spark, sf, "pages")
    html = F.replace(F.replace("html", F.lit("<p>"), F.lit("<i>")), F.lit("</p>"), F.lit("</i>"))
    return pages.select("page_id", strip_markup(html, S.MARKUP).alias("html"))


@query
def q_clean_rename(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.rename_strict(T.table(spark, sf, "customer"), {"c_custkey": "record_id", "c_name": "genus"})
    return df.select("record_id", "genus", F.col("genus").alias("genericName"), "c_mktsegment")


@query
def q_clean_drop(spark: SparkSession, sf: str) -> DataFrame:
    df = T.table(spark, sf, "customer").withColumn("Unnamed: 17", F.lit("x"))
    return clean.drop_prefix(clean.drop_strict(df, ["c_acctbal", "c_nationkey"]), "Unnamed")


@query
def q_profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return clean.null_profile(T.raw_checklist(spark, sf))


@query
def q_drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_all_null(T.raw_checklist(spark, sf))


@query
def q_correct(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.rename_strict(T.raw_checklist(spark, sf), T.RENAMES)
    df = clean.trim_strings(df).withColumn("genericName", F.col("genus"))
    df = clean.apply_corrections(clean.fill_blank(df, ["infraspecificEpithet"]), T.CORRECTIONS)
    return df.select("speciesId", "genericName", "specificEpithet", "infraspecificEpithet")


@query
def q_correct_table(spark: SparkSession, sf: str) -> DataFrame:
    nodes = T.backbone(spark, sf).where("infraspecificEpithet IS NULL AND specificEpithet IS NOT NULL")
    rules = nodes.select(
        "genus", F.concat("specificEpithet", F.lit("x")).alias("specificEpithet"), F.col("specificEpithet").alias("corrected")
    )
    records = T.cleaned_checklist(spark, sf).select("speciesId", "genus", "specificEpithet")
    return clean.correct_from_table(records, rules, ["genus", "specificEpithet"], "specificEpithet", join=attach)


@query
def q_map_category(spark: SparkSession, sf: str) -> DataFrame:
    rules = {"goods": ("AUTOMOBILE", "MACHINERY"), "home": ("HOUSEHOLD", "FURNITURE")}
    return T.table(spark, sf, "customer").select(
        "c_custkey", category(F.col("c_mktsegment"), rules, "other").alias("kind")
    )


@query
def q_null_normalise(spark: SparkSession, sf: str) -> DataFrame:
    filled = clean.fill_blank(T.backbone(spark, sf)).select(
        S.NODE_ID, S.ACCEPTED_ID, S.CANONICAL, "family", "genus", "specificEpithet", "infraspecificEpithet"
    )
    return clean.blank_to_null(filled, ["specificEpithet", "infraspecificEpithet"])


@query
def q_cast_ids(spark: SparkSession, sf: str) -> DataFrame:
    orders = T.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.concat("o_orderstatus", F.col("o_custkey").cast("string")).alias("mixed_id"),
    )
    return clean.cast_ids(clean.cast_ids(orders, ["order_id"]), ["mixed_id"], malformed="null")


@query
def q_derive_token(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = T.cleaned_checklist(spark, sf)
    derived = clean.derive_genus(cleaned)
    return derived.select("speciesId", "taxonName", "genus", first_token(F.col("taxonName")).alias("token"))


@query
def q_clean_records(spark: SparkSession, sf: str) -> DataFrame:
    return T.stored_checklist(spark, sf)


@query
def q_infer_schema(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.table(spark, sf, "lineitem")
    return clean.infer_types(lines.select([F.col(c).cast("string").alias(c) for c in lines.columns]))


# --- files -----------------------------------------------------------------------------


@query
def q_read_records(spark: SparkSession, sf: str) -> DataFrame:
    # Headers that differ in case only, and empty strings beside nulls.
    log = F.when(F.col("query") == "F", F.when(F.col("subspecies").isNull(), "").otherwise(F.col("subspecies")))
    with case_sensitive(spark):
        folder = working_folder(spark, "checklist-csv")
        write_csv(T.raw_checklist(spark, sf).withColumn("Query", log), folder)
        read = clean.rename_strict(read_records(spark, folder), {"Query": "log"})
        return store(read, "records")


def _checked_backbone(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Nodes written as lines, some with a column too many or an id that is no number, and read again."""
    nodes = T.backbone(spark, sf)
    schema = string_schema(nodes.columns)
    shown = nodes.withColumn(
        S.ACCEPTED_ID, F.when(F.col(S.NODE_ID) % 89 == 0, "none").otherwise(F.col(S.ACCEPTED_ID).cast("string"))
    )
    fields = [F.coalesce(F.col(quote(c)).cast("string"), F.lit("")) for c in nodes.columns]
    more = F.when(F.col(S.NODE_ID) % 97 == 0, "\tsurplus").otherwise("")
    folder = working_folder(spark, "backbone-tsv")
    shown.select(F.concat(F.concat_ws("\t", *fields), more).alias("value")).write.text(folder)
    return read_backbone_checked(spark, folder, schema, header=False)


@query
def q_read_backbone(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_backbone(spark, sf)[0]


@query
def q_read_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_backbone(spark, sf)[1]


# --- exact match ---------------------------------------------------------------------


@query
def q_backbone_prepare(spark: SparkSession, sf: str) -> DataFrame:
    return match.prepare_backbone(T.backbone(spark, sf))


@query
def q_backbone_generic(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes without a genus take their generic name: every third node of the table has lost its genus."""
    genus = F.when(F.col(S.NODE_ID) % 3 != 0, F.col("genus"))
    return match.prepare_backbone(T.backbone(spark, sf).withColumn("genus", genus), genus_from_generic=True)


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned checklist as a table, for queries that read it more than once."""
    return T.stored_checklist(spark, sf)


def _backbone(spark: SparkSession, sf: str) -> DataFrame:
    """The authority table as a table, for queries that read it more than once."""
    return store(T.backbone(spark, sf), "backbone")


def _found(spark: SparkSession, sf: str) -> DataFrame:
    nodes = match.prepare_backbone(T.backbone(spark, sf))
    return match.candidates(_cleaned(spark, sf), nodes, join=attach)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    nodes = match.prepare_backbone(T.backbone(spark, sf))
    return match.exact_match(_cleaned(spark, sf), nodes, join=attach)


# What a parent depends on.
_RANKED = (S.RECORD_ID, *S.RANKS)


def _unmatched(spark: SparkSession, sf: str, backbone: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The unmatched records as a table, with the ``columns`` that a query looks at, by default all."""
    found = find_unmatched(_cleaned(spark, sf), backbone)
    return store(found if columns is None else found.select(*map(quote, columns)), "unmatched")


_PAIR_COLUMNS = [
    S.RECORD_ID, S.MATCHED_ID, S.ACCEPTED_ID, "kingdom", "genus", "genericName", "specificEpithet", "infraspecificEpithet",
]


@query
def q_exact_match(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select(_PAIR_COLUMNS)


@query
def q_exact_record_name(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs that keep the record's generic name."""
    nodes = match.prepare_backbone(T.backbone(spark, sf))
    pairs = match.exact_match(_cleaned(spark, sf), nodes, generic_name="record", join=attach)
    return pairs.select(_PAIR_COLUMNS)


@query
def q_ambiguous_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The second output of dropping ambiguous records: all their pairs."""
    pairs = store(_pairs(spark, sf).select(_PAIR_COLUMNS), "pairs")
    return match.resolve_ambiguous(pairs, join=attach)[1]


@query
def q_backed_left(spark: SparkSession, sf: str) -> DataFrame:
    """The second output of keeping backed pairs: pairs of ambiguous records that no accepted node backs."""
    pairs = store(_pairs(spark, sf).select(_PAIR_COLUMNS), "pairs")
    return match.resolve_ambiguous(pairs, on_ambiguous="accepted_backed", join=attach)[1]


@query
def q_exact_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _found(spark, sf).select(*_PAIR_COLUMNS, "n_nodes", "is_repeated")


@query
def q_unique_only(spark: SparkSession, sf: str) -> DataFrame:
    exact, bare, _ = match.split_candidates(_found(spark, sf))
    return exact.unionByName(bare).select(_PAIR_COLUMNS)


@query
def q_unique_matches(spark: SparkSession, sf: str) -> DataFrame:
    return match.split_candidates(_found(spark, sf))[0].select(_PAIR_COLUMNS)


@query
def q_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    return match.split_candidates(_found(spark, sf))[2].select(S.RECORD_ID, "genus", "n_nodes", "is_repeated")


@query
def q_duplicates_only(spark: SparkSession, sf: str) -> DataFrame:
    return joins.repeated_keys(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q_accepted_backed(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = _cleaned(spark, sf).withColumnRenamed("speciesId", S.RECORD_ID)
    nodes = match.prepare_backbone(_backbone(spark, sf))
    slim = joins.flag_repeated(cleaned.select(S.RECORD_ID, *S.EXACT_KEYS), S.RECORD_ID, join=attach)
    counts = match.node_keys(nodes, carry=()).select(*S.EXACT_KEYS, "n_nodes")
    found = attach(slim, counts, S.EXACT_KEYS).fillna({"n_nodes": 0})
    backed = match.accepted_backed(found, nodes, join=attach)
    return backed.select(S.RECORD_ID, *S.EXACT_KEYS, "n_nodes", "n_backed", "first_backed")


@query
def q_accepted_backed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    nodes = match.prepare_backbone(_backbone(spark, sf))
    found = store(match.candidates(_cleaned(spark, sf), nodes, join=attach), "candidates")
    exact, bare, _ = match.split_candidates(found)
    backed = match.backed_pairs(found, nodes, join=attach)
    return exact.unionByName(bare).unionByName(backed).select(_PAIR_COLUMNS)


@query
def q_no_match(spark: SparkSession, sf: str) -> DataFrame:
    return _unmatched(spark, sf, T.backbone(spark, sf)).select(*map(quote, S.OUTPUT_COLUMNS))


# --- set operators -------------------------------------------------------------------


@query
def q_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return T.table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


@query
def q_semi(spark: SparkSession, sf: str) -> DataFrame:
    orders = T.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    return joins.keep_keys(T.table(spark, sf, "customer").select("c_custkey", "c_name"), urgent, ["c_custkey"], attach)


@query
def q_anti(spark: SparkSession, sf: str) -> DataFrame:
    orders = T.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    return joins.drop_keys(T.table(spark, sf, "customer").select("c_custkey", "c_name"), urgent, ["c_custkey"], attach)


@query
def q_semi_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the parts of some brands, as where the wanted keys exceed a broadcast."""
    lines = T.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber")
    wanted = T.table(spark, sf, "part").where(F.col("p_brand").startswith("Brand#2"))
    return joins.keep_keys(lines, wanted, ["p_partkey"], partial(attach, limit=0))


# --- shared names --------------------------------------------------------------------


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return homonyms.accepted_names(T.backbone(spark, sf), T.KINGDOMS)


@query
def q_homonyms(spark: SparkSession, sf: str) -> DataFrame:
    names = store(_names(spark, sf), "names")
    groups = homonyms.homonym_groups(names, join=attach)
    return groups.select(S.CANONICAL, S.NODE_ID, "kingdom", "phylum", "genus").orderBy(S.CANONICAL, S.NODE_ID)


@query
def q_homonym_features(spark: SparkSession, sf: str) -> DataFrame:
    found = homonyms.homonym_features(_names(spark, sf))
    # The name breaks ties, so that equal lists are split over the ranges and the order is total.
    return found.orderBy("features", S.CANONICAL).select(
        S.CANONICAL, "features_text", F.size("features").cast("long").alias("n_features")
    )


@query
def q_homonym_pick(spark: SparkSession, sf: str) -> DataFrame:
    return homonyms.homonym_picks(homonyms.homonym_table(_names(spark, sf)))


@query
def q_homonym_assign(spark: SparkSession, sf: str) -> DataFrame:
    bb = _backbone(spark, sf)
    first = homonyms.homonym_assign(_unmatched(spark, sf, bb, _RANKED), bb, T.KINGDOMS, join=attach)
    return first.select(S.RECORD_ID, *S.RANKS[2:], S.PARENT_ID)


@query
def q_homonym_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    records, bb = store(T.supplier_records(spark, sf), "suppliers"), _backbone(spark, sf)
    first = homonyms.homonym_assign(records, bb, T.KINGDOMS, join=attach)
    return first.select("record_id", "family", "genus", S.PARENT_ID)


@query
def q_unresolvable(spark: SparkSession, sf: str) -> DataFrame:
    # Orders share their names with genera: without the nodes of orders, the names remain
    # but no node qualifies.
    bb = _backbone(spark, sf)
    others = bb.where(F.col(S.NODE_RANK) != "order")
    return homonyms.unresolvable_homonyms(_unmatched(spark, sf, bb, _RANKED), others, T.KINGDOMS, join=attach)


# --- parents by level ----------------------------------------------------------------


def _filled_once(spark: SparkSession, sf: str) -> DataFrame:
    filled = clean.fill_blank(T.cleaned_checklist(spark, sf)).withColumnRenamed("speciesId", S.RECORD_ID)
    return filled.select(S.RECORD_ID, *map(quote, S.RANKS))


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    """The ranks of all records as a table, for queries that filter or join by derived keys."""
    return store(_filled_once(spark, sf), "records")


@query
def q_lowest_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _filled_once(spark, sf).select(
        S.RECORD_ID, lowest_rank(S.RANKS).alias("lowest_rank"), lowest_name(S.RANKS).alias("lowest_name")
    )


@query
def q_presence_mask(spark: SparkSession, sf: str) -> DataFrame:
    return levels.record_levels(_filled_once(spark, sf)).select(S.RECORD_ID, *levels.level_columns())


@query
def q_unmatched_names(spark: SparkSession, sf: str) -> DataFrame:
    return levels.unmatched_names(_filled(spark, sf))


@query
def q_rank_backbone(spark: SparkSession, sf: str) -> DataFrame:
    return levels.rank_backbone(T.backbone(spark, sf), T.KINGDOMS)


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return levels.rank_backbone(T.backbone(spark, sf), T.KINGDOMS)


def _rank_match(level: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        one = [v for v in S.LEVELS if v.name == level]
        found = levels.count_parents(_filled(spark, sf), _nodes(spark, sf), one, join=attach)
        return found.where("n_parents > 0").select(
            S.RECORD_ID, *map(quote, one[0].keys), "n_parents", "first_parent"
        )

    return run


for _level in S.LEVELS:
    QUERIES[f"q_rank_match_{_level.name.lower()}"] = _rank_match(_level.name)


@query
def q_rank_match_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = levels.rank_match(_filled(spark, sf), _nodes(spark, sf), keep_level=True, join=attach)
    return pairs.select(S.RECORD_ID, "level", S.PARENT_ID)


@query
def q_rank_match_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs of all levels with the pairs of every name over 2000 cut into a grid of cells."""
    cut = partial(attach_pairs, cell_pairs=2000)
    pairs = levels.rank_match(_filled(spark, sf), _nodes(spark, sf), keep_level=True, join=attach, pair_join=cut)
    return pairs.select(S.RECORD_ID, "level", S.PARENT_ID)


@query
def q_rank_match_kingdom(spark: SparkSession, sf: str) -> DataFrame:
    found = levels.count_parents(
        _filled(spark, sf), _nodes(spark, sf), extra_keys=["kingdom"], join=attach
    )
    return found.where("n_parents > 0").select(S.RECORD_ID, "level", "n_parents", "first_parent")


# --- the whole job -------------------------------------------------------------------


def _assigned(spark: SparkSession, sf: str, columns: Sequence[str] | None = None) -> DataFrame:
    bb = _backbone(spark, sf)
    return assign_parents(_unmatched(spark, sf, bb, columns), bb, T.KINGDOMS)


@query
def q_second_stage(spark: SparkSession, sf: str) -> DataFrame:
    second = _assigned(spark, sf, _RANKED).where("stage = 'second'")
    return second.select(S.RECORD_ID, "level", "n_parents", S.PARENT_ID)


@query
def q_all_matches(spark: SparkSession, sf: str) -> DataFrame:
    matches = _assigned(spark, sf, (*_RANKED, "taxonName")).where("stage <> 'none'")
    return matches.select(S.RECORD_ID, "taxonName", *S.RANKS, "stage", "n_parents", S.PARENT_ID)


@query
def q_remainder(spark: SparkSession, sf: str) -> DataFrame:
    rest = _assigned(spark, sf).where("stage = 'none'")
    return rest.select(*map(quote, S.OUTPUT_COLUMNS))


@query
def q_summary(spark: SparkSession, sf: str) -> DataFrame:
    assigned = _assigned(spark, sf, _RANKED).select(S.RECORD_ID, "stage", "n_parents")
    return assigned.groupBy("stage").agg(
        F.count("*").alias("n_rows"), F.sum("n_parents").alias("n_parents"), F.count_distinct(S.RECORD_ID).alias("n_records")
    )


@query
def q_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    bb = _backbone(spark, sf)
    records = _unmatched(spark, sf, bb, _RANKED)
    first = store(homonyms.homonym_assign(records, bb, T.KINGDOMS, join=attach), "first")
    # Stored, as the second search reads it for its orders, its hot names and its rows.
    waiting = store(joins.drop_keys(records, first, [S.RECORD_ID], partial(attach, apart="filter")), "waiting")
    # Stored, as both the matches and the remainder read it.
    second = store(levels.rank_match(waiting, levels.rank_backbone(bb, T.KINGDOMS), multi="first", join=attach), "second")
    matches, remainder = reconcile.reconcile(records, first, second, join=attach)
    return reconcile.match_summary(
        unmatched=records, first_matches=first, second_matches=second, all_matches=matches, remainder=remainder
    )


def _results(spark: SparkSession, sf: str, **options: str) -> Results:
    return match_checklist(T.stored_checklist(spark, sf), _backbone(spark, sf), kingdoms=T.KINGDOMS, **options)


def _checklist(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _results(spark, sf)[name].select(*map(quote, S.OUTPUT_COLUMNS))

    return run


QUERIES["q_checklist_second"] = _checklist("second_matches")
QUERIES["q_checklist_all"] = _checklist("all_matches")
QUERIES["q_checklist_remainder"] = _checklist("remainder")


@query
def q_checklist_backed(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf, on_ambiguous="accepted_backed")["exact"].select(_PAIR_COLUMNS)


@query
def q_checklist_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarise(_results(spark, sf))


@query
def q_written_results(spark: SparkSession, sf: str) -> DataFrame:
    folder = working_folder(spark, "results")
    # Names come many times each, in up to three results: the plain files would be the most of what is written.
    write_results(_results(spark, sf), folder, compression="gzip")
    return read_results(spark, folder)


@query
def q_inspect(spark: SparkSession, sf: str) -> DataFrame:
    bb = _backbone(spark, sf)
    columns = [S.RECORD_ID, "taxonName", *S.RANKS]
    # Only the columns that are looked at, or that a parent depends on, are stored.
    records = store(find_unmatched(_cleaned(spark, sf), bb).select(columns), "unmatched")
    return inspect_parents(
        records,
        bb,
        [S.RECORD_ID, "taxonName", S.PARENT_ID, *S.RANKS],
        where=F.col("phylum") == "Brand#21",
        order_by=[S.PARENT_ID, S.RECORD_ID],
        kingdoms=T.KINGDOMS,
    )
