"""The whole matching job, from raw checklist and authority table to its six results.

Results are computed on request: a stage is stored when the first result that reads it is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import quote
from rankmatch.operators.homonyms import accepted_names, homonym_parents, parent_table, parents_by_rank
from rankmatch.operators.joins import Join, attach, attach_pairs, attach_stored, drop_keys
from rankmatch.operators.levels import (
    count_parents,
    rank_backbone,
    rank_match,
    record_levels,
    within_values,
)
from rankmatch.operators.match import (
    backed_pairs,
    candidates,
    label_unmatched,
    prepare_backbone,
    split_candidates,
)
from rankmatch.operators.reconcile import inspect, match_summary
from rankmatch.session import shared_dir, store, store_observed
from rankmatch.settings import Level
from rankmatch.sources.files import read_records, string_schema, write_csv


def assign_parents(
    records: DataFrame,
    backbone: DataFrame,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    ranks: Sequence[str] = S.RANKS,
    levels: Sequence[Level] = S.LEVELS,
    tie_rank: str | None = S.TIE_RANK,
    tie_columns: Sequence[str] = S.TIE_COLUMNS,
    name: str = S.CANONICAL,
    parent_id: str = S.PARENT_ID,
    base: str | None = None,
    extra_keys: Sequence[str] = (),
    only: Column | str | None = None,
) -> DataFrame:
    """Every unmatched record once: ``stage``, ``level``, ``n_parents`` and its parent.

    ``stage`` is ``first`` for parents from shared names, ``second`` for parents by level,
    ``none`` for the remainder; with several parents the smallest id is given.  Both
    searches look a record up in a table with one row per name, so the records are
    shuffled at most twice and never multiplied.

    ``records`` should be a stored table: it is read once in full and, for the few columns
    each needs, to find lone targets and the orders of the family level.

    ``only`` keeps the records that satisfy it.  What a parent depends on, the lone targets and the
    orders of the family level, is still taken from all records; the searches see the kept ones.
    """
    columns = [c for c in records.columns if c != parent_id]
    records = records.select(*map(quote, columns))
    names = accepted_names(backbone, kingdoms, ranks, name)
    table = store(parent_table(records, names, ranks, tie_rank, tie_columns, name), "parents", base)

    for level in levels:
        # Records of a level share their lowest name, so which values of the level are still
        # wanted is known per name, before any record is looked up.
        finest = next(r for r in ranks if r in level.filled)
        if level.within and (level.keys[0] != finest or set(ranks[: ranks.index(finest)]) - set(level.blank)):
            raise ValueError(f"level {level.name!r} has 'within', but its first key is not the lowest rank")
    attach_here = partial(attach, base=base)
    seen = within_values(record_levels(records, levels), levels)
    if seen is not None:
        targets = seen.withColumnsRenamed({"level": "lowest_rank", "level_name": "lowest_name"})
        done = parents_by_rank(table, ranks)
        seen = drop_keys(targets, done, ["lowest_rank", "lowest_name"]).withColumnRenamed(
            "lowest_rank", "level"
        )

    wanted = records if only is None else records.where(only)
    first = homonym_parents(wanted, table, ranks, partial(attach_stored, apart="filter"))
    found = count_parents(
        first,
        rank_backbone(backbone, kingdoms, ranks),
        levels,
        extra_keys=extra_keys,
        waiting=F.col("homonym_parent").isNull(),
        seen=seen,
        join=attach_here,
        source=wanted,
    )
    is_first, is_second = F.col("homonym_parent").isNotNull(), F.col("n_parents") > 0
    return found.select(
        *map(quote, columns),
        F.when(is_first, "first").when(is_second, "second").otherwise("none").alias("stage"),
        F.when(is_second, F.col("level")).alias("level"),
        F.when(is_first, F.lit(1).cast("long")).otherwise(F.col("n_parents")).alias("n_parents"),
        F.coalesce("homonym_parent", "first_parent").alias(parent_id),
    )


def find_unmatched(
    cleaned: DataFrame,
    backbone: DataFrame,
    statuses: Sequence[str] = S.MATCHABLE_STATUSES,
    join: Join = attach,
) -> DataFrame:
    """The unambiguous records of a cleaned checklist without node, labelled."""
    # The generic name is the node's, so it is empty where there is none.
    records, nodes = cleaned.drop("genericName"), prepare_backbone(backbone, statuses)
    found = candidates(records, nodes, carry=(), join=join)
    return label_unmatched(split_candidates(found)[1])


# Results that are written as CSV.
RESULTS = (
    "first_matches",
    "second_matches_phylum",
    "second_matches_genus",
    "second_matches",
    "all_matches",
    "remainder",
)


class Results(Mapping[str, DataFrame]):
    """The results of :func:`match_checklist` by name, each computed from the stages it needs.

    ``exact`` and ``ambiguous`` need the candidates; ``unmatched``, ``first_matches`` and
    ``remainder`` also the parents; the others also the pairs of records and parents.
    """

    NAMES = ("exact", "ambiguous", "unmatched", *RESULTS)

    def __init__(
        self,
        cleaned: DataFrame,
        backbone: DataFrame,
        statuses: Sequence[str],
        kingdoms: Sequence[str],
        levels: Sequence[Level],
        multi: str,
        base: str | None,
        on_ambiguous: str,
        generic_name: str,
        genus_from_generic: bool,
        extra_keys: Sequence[str],
        tie_rank: str | None,
        tie_columns: Sequence[str],
        labels: Mapping[str, str],
    ):
        self.cleaned, self.backbone, self.base = cleaned, backbone, base
        self.kingdoms, self.levels, self.multi, self.extra_keys = kingdoms, levels, multi, extra_keys
        self.on_ambiguous, self.generic_name, self.labels = on_ambiguous, generic_name, labels
        self.ties = {"tie_rank": tie_rank, "tie_columns": tie_columns}
        self.nodes = prepare_backbone(backbone, statuses, genus_from_generic)
        self.attach = partial(attach, base=base)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, f"_{name}")

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    @cached_property
    def _candidates(self) -> DataFrame:
        carry = ("genericName",) if self.generic_name == "node" else ()
        return candidates(self.cleaned, self.nodes, carry=carry, join=self.attach)

    @cached_property
    def found(self) -> DataFrame:
        """Stage: every record with its number of nodes."""
        return store(self._candidates, "candidates", self.base)

    @cached_property
    def backed(self) -> DataFrame:
        """Stage: the pairs of ambiguous records that are kept."""
        pairs = backed_pairs(self.found, self.nodes, generic_name=self.generic_name, join=self.attach)
        return store(pairs, "backed", self.base)

    @cached_property
    def _exact(self) -> DataFrame:
        exact = split_candidates(self.found)[0]
        return exact if self.on_ambiguous == "drop" else exact.unionByName(self.backed)

    @cached_property
    def _ambiguous(self) -> DataFrame:
        ambiguous = split_candidates(self.found)[2]
        if self.on_ambiguous == "drop":
            return ambiguous
        return drop_keys(ambiguous, self.backed, [S.RECORD_ID], self.attach)

    @cached_property
    def bare(self) -> DataFrame:
        # Where no result has asked for all candidates, those with nodes or repeated ids are not stored for this.
        found = self.found if "found" in self.__dict__ else self._candidates
        return label_unmatched(split_candidates(found)[1], self.labels)

    @property
    def columns(self) -> list[str]:
        return list(map(quote, self.bare.columns))

    @cached_property
    def _counted(self) -> tuple[DataFrame, dict[str, int]]:
        """Stage: every unmatched record with its parent, and how many there are of each kind."""
        records = store(self.bare, "unmatched", self.base)
        assigned = assign_parents(
            records, self.backbone, self.kingdoms, levels=self.levels, base=self.base, extra_keys=self.extra_keys, **self.ties
        )
        measures = {}
        for kind, test in self._kinds.items():
            measures[kind] = F.count_if(F.expr(test))
            measures[f"{kind} ids"] = F.count_if(F.expr(f"({test}) AND {quote(S.RECORD_ID)} IS NOT NULL"))
        return store_observed(assigned, "assigned", measures, self.base)

    _kinds = {
        "unmatched": "true",
        "first_matches": "stage = 'first'",
        "second_matches": "stage = 'second'",
        "second_matches_phylum": "stage = 'second' AND level = 'phylum'",
        "second_matches_genus": "stage = 'second' AND level = 'genus'",
        "all_matches": "stage <> 'none'",
        "remainder": "stage = 'none'",
    }

    @property
    def assigned(self) -> DataFrame:
        return self._counted[0]

    @cached_property
    def _leveled(self) -> tuple[DataFrame, dict[str, int]]:
        """Stage: the records of the second search, once per parent, with their level."""
        if self.multi == "first":
            return self.assigned.where("stage = 'second'").select(*self.columns, "level"), {}
        waiting = self.assigned.where("stage = 'second'").select(self.columns)
        # Which orders are wanted at the family level follows from all records that wait.
        seen = within_values(record_levels(self.assigned.where("stage <> 'first'"), self.levels), self.levels)
        pairs = rank_match(
            waiting, rank_backbone(self.backbone, self.kingdoms), self.levels, self.multi, self.extra_keys,
            keep_level=True, join=self.attach, pair_join=partial(attach_pairs, base=self.base), seen=seen,
        )
        measures = {
            "second_matches": F.count("*"),
            "second_matches_phylum": F.count_if(F.col("level") == "phylum"),
            "second_matches_genus": F.count_if(F.col("level") == "genus"),
        }
        return store_observed(pairs, "leveled", measures, self.base)

    @property
    def leveled(self) -> DataFrame:
        return self._leveled[0]

    @property
    def _unmatched(self) -> DataFrame:
        none = F.lit(None).cast("long").alias(S.PARENT_ID)
        return self.assigned.select(*[none if c == S.PARENT_ID else quote(c) for c in self.bare.columns])

    @property
    def _first_matches(self) -> DataFrame:
        return self.assigned.where("stage = 'first'").select(self.columns)

    @property
    def _second_matches_phylum(self) -> DataFrame:
        return self.leveled.where("level = 'phylum'").select(self.columns)

    @property
    def _second_matches_genus(self) -> DataFrame:
        return self.leveled.where("level = 'genus'").select(self.columns)

    @property
    def _second_matches(self) -> DataFrame:
        return self.leveled.select(self.columns)

    @property
    def _all_matches(self) -> DataFrame:
        return self._second_matches.unionByName(self._first_matches)

    @property
    def _remainder(self) -> DataFrame:
        return self.assigned.where("stage = 'none'").select(self.columns)

    def counts(self) -> list[tuple[str, int, int]]:
        """(result, rows, different ids), as counted while the stages were stored.

        Ids are not repeated among the unmatched records, so a stage has as many ids as records.
        """
        records, pairs = self._counted[1], self._leveled[1]
        rows = {kind: pairs.get(kind, records[kind]) for kind in self._kinds}
        rows["all_matches"] = rows["first_matches"] + rows["second_matches"]
        return [(kind, rows[kind], records[f"{kind} ids"]) for kind in ("unmatched", *RESULTS)]

    def tagged(self) -> DataFrame:
        """Every row of every written result with the name of its ``result``, from one pass over each stage."""
        level = F.col("level")

        def tags(*cases: tuple[str, Column | None]) -> Column:
            names = F.array(*[F.lit(n) if c is None else F.when(c, F.lit(n)) for n, c in cases])
            return F.explode(F.array_compact(names)).alias("result")

        first, rest = F.col("stage") == "first", F.col("stage") == "none"
        own = self.assigned.where("stage <> 'second'").select(
            *self.columns, tags(("first_matches", first), ("all_matches", first), ("remainder", rest))
        )
        pairs = self.leveled.select(
            *self.columns,
            tags(
                ("second_matches", None), ("all_matches", None),
                ("second_matches_phylum", level == "phylum"), ("second_matches_genus", level == "genus"),
            ),
        )
        return own.unionByName(pairs)


def match_checklist(
    cleaned: DataFrame,
    backbone: DataFrame,
    statuses: Sequence[str] = S.MATCHABLE_STATUSES,
    kingdoms: Sequence[str] = S.PARENT_KINGDOMS,
    levels: Sequence[Level] = S.LEVELS,
    multi: str = "all",
    base: str | None = None,
    on_ambiguous: str = "drop",
    generic_name: str = "node",
    genus_from_generic: bool = False,
    extra_keys: Sequence[str] = (),
    tie_rank: str | None = S.TIE_RANK,
    tie_columns: Sequence[str] = S.TIE_COLUMNS,
    labels: Mapping[str, str] = S.UNMATCHED_LABELS,
) -> Results:
    """All results of the job on a cleaned checklist, by name; see :class:`Results`.

    Stages that several results need are written once to the shared folder (``base``, by
    default the one the session names), so a lost executor costs a stage and not the job.
    The options are those of the operators: ``on_ambiguous`` of ``resolve_ambiguous``,
    ``generic_name`` of ``exact_match``, ``genus_from_generic`` of ``prepare_backbone``,
    ``extra_keys`` of ``rank_match``, the tie-break's and the labels.
    """
    if on_ambiguous not in ("drop", "accepted_backed"):
        raise ValueError(f"on_ambiguous must be 'drop' or 'accepted_backed', not {on_ambiguous!r}")
    if generic_name not in ("node", "record"):
        raise ValueError(f"generic_name must be 'node' or 'record', not {generic_name!r}")
    if multi not in ("all", "first"):
        raise ValueError(f"multi must be 'all' or 'first', not {multi!r}")
    return Results(
        cleaned, backbone, statuses, kingdoms, levels, multi, base or shared_dir(cleaned.sparkSession), on_ambiguous,
        generic_name, genus_from_generic, extra_keys, tie_rank, tie_columns, labels,
    )


def inspect_parents(
    records: DataFrame,
    backbone: DataFrame,
    columns: Sequence[str],
    where: Column | str,
    order_by: Sequence[str] = (),
    **options: object,
) -> DataFrame:
    """Chosen columns of the unmatched ``records`` that satisfy ``where``, with their parents.

    Two phases: what a parent depends on is counted over all records, from the rank columns alone;
    the parents are then looked up for the rows asked for only.  ``where`` is about the records'
    own columns.  ``options`` are those of :func:`assign_parents`.
    """
    return inspect(assign_parents(records, backbone, only=where, **options), columns, order_by=order_by)


def write_results(results: Results, folder: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """The six results as CSV, columns in output order, a folder ``result=<name>`` for each.

    One job writes all of them: a row goes to the folders of all results it is in.  ``compression`` is
    that of :func:`write_csv`; :func:`read_results` reads either form.
    """
    table = results.tagged().select("result", *map(quote, S.OUTPUT_COLUMNS))
    write_csv(table, folder, mode, ["result"], compression)


def read_results(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`write_results` wrote: ``result`` and the output columns, null and ``''`` told apart."""
    ids = [S.MATCHED_ID, S.ACCEPTED_ID, S.PARENT_ID]
    return read_records(spark, folder, string_schema(S.OUTPUT_COLUMNS), ids)


def summarise(results: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct records of every result and of the unmatched records.

    For :class:`Results` they were counted while the stages were stored; other tables are read.
    """
    if isinstance(results, Results):
        return results.cleaned.sparkSession.createDataFrame(results.counts(), "stage string, n_rows long, n_records long")
    return match_summary(**{name: results[name] for name in ("unmatched", *RESULTS)})
