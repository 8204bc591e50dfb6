import glob
import os

import pytest
from pyspark.sql import functions as F

from rankmatch import session
from rankmatch import settings as S
from rankmatch.operators import joins
from rankmatch.operators.clean import clean_records
from rankmatch.operators.reconcile import match_summary
from rankmatch.plans.flow import (
    RESULTS,
    assign_parents,
    inspect_parents,
    match_checklist,
    read_results,
    summarise,
    write_results,
)
from rankmatch.session import deal, shared_dir, spread, store, store_observed, working_folder
from tests.helpers import frame, loop_homonyms, loop_levels, node, nodes_frame, record, records_frame, rows
from tests.test_homonyms import sample as homonym_sample
from tests.test_levels import sample as level_sample

RAW = [
    {"speciesId": "e1", "phylum": "P1", "class": "C1", "order": "O1", "family": "F1", "genus": "Aus", "species": "bus"},
    {"speciesId": "d1", "phylum": "P1"},
    {"speciesId": "d1", "phylum": "P2"},
    {"speciesId": "a1", "phylum": "P1", "class": "C1", "order": "O1", "family": "F1", "genus": "Aus", "species": "twice"},
    {"speciesId": "h1", "phylum": "P2", "class": "C2", "order": "O2", "family": "F2", "genus": "Hus"},
    {"speciesId": "p1", "phylum": " P1 "},
    {"speciesId": "g1", "phylum": "P1", "class": "C1", "order": "O1", "family": "F1", "genus": "Aus"},
    {"speciesId": "x1", "phylum": "P1", "order": "O1"},
    {"speciesId": "n1", "phylum": "Nowhere"},
]
RAW_DDL = (
    "speciesId string, taxonName string, `domain ` string, phylum string, `class` string, `order` string,"
    " family string, genus string, species string, subspecies string, `data cleanup changes` string"
)
P1 = {"kingdom": "Animalia", "phylum": "P1"}
F1 = {**P1, "class": "C1", "order": "O1", "family": "F1"}
NODES = [
    node(1, "Aus bus", "species", **{**F1, "genus": "Aus", "specificEpithet": "bus"}),
    node(2, "Aus twice", "species", **{**F1, "genus": "Aus", "specificEpithet": "twice"}),
    node(3, "Aus twice", "species", "synonym", 2, **{**F1, "genus": "Aus", "specificEpithet": "twice"}),
    node(4, "Hus", "genus", **{**F1, "genus": "Hus"}),
    node(5, "Hus", "genus", kingdom="Plantae", phylum="P2", **{"class": "C2"}, order="O2", family="F2", genus="Hus"),
    node(6, "P1", "phylum", **P1),
    node(7, "Aus", "genus", **{**F1, "genus": "Aus"}),
    node(8, "Aus2", "subgenus", **{**F1, "genus": "Aus"}),
]


@pytest.fixture(scope="module")
def results(spark):
    raw = frame(spark, [{"taxonName": "x", "data cleanup changes": "y", "domain ": "d", **r} for r in RAW], RAW_DDL)
    cleaned = clean_records(raw, log_columns=["data cleanup changes 1"])
    return match_checklist(cleaned, nodes_frame(spark, NODES))


def parents(df):
    return rows(df.select("speciesID", "parentNameUsageID"))


def test_every_record_ends_in_one_place(results):
    assert rows(results["exact"].select("speciesID", "matched_taxonID")) == [("e1", 1)]
    assert rows(results["ambiguous"].select("speciesID", "n_nodes", "is_repeated")) == [
        ("a1", 2, False), ("d1", 0, True), ("d1", 0, True),
    ]
    # The single record of a shared name equals the second node, so it takes that one.
    assert parents(results["first_matches"]) == [("h1", 5)]
    assert parents(results["second_matches_phylum"]) == [("p1", 6)]
    assert parents(results["second_matches_genus"]) == [("g1", 7), ("g1", 8)]
    assert parents(results["all_matches"]) == [("g1", 7), ("g1", 8), ("h1", 5), ("p1", 6)]
    assert rows(results["remainder"].select("speciesID")) == [("n1",), ("x1",)]


def test_stages_add_up(results):
    first, second = results["first_matches"], results["second_matches"]
    assert first.join(second, "speciesID").count() == 0
    assert results["all_matches"].count() == first.count() + second.count()
    ids = results["all_matches"].select("speciesID").distinct().union(results["remainder"].select("speciesID"))
    assert rows(ids) == rows(results["unmatched"].select("speciesID"))


def test_summary_has_all_stages(results):
    got = {r.stage: (r.n_rows, r.n_records) for r in summarise(results).collect()}
    assert set(got) == {"unmatched", *RESULTS}
    assert got["all_matches"] == (4, 3)
    assert got["unmatched"] == (5, 5)


def test_results_are_written_in_output_order(results, tmp_path):
    write_results(results, str(tmp_path / "out"))
    for name in RESULTS:
        part = sorted(glob.glob(f"{tmp_path}/out/result={name}/part-*"))[0]
        with open(part, encoding="utf-8") as f:
            assert f.readline().strip() == ",".join(S.OUTPUT_COLUMNS)


def test_first_of_several_parents(spark, results):
    raw = frame(spark, [{"taxonName": "x", "data cleanup changes": "y", "domain ": "d", **r} for r in RAW], RAW_DDL)
    cleaned = clean_records(raw, log_columns=["data cleanup changes 1"])
    got = match_checklist(cleaned, nodes_frame(spark, NODES), multi="first")
    assert parents(got["all_matches"]) == [("g1", 7), ("h1", 5), ("p1", 6)]


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_BYTES])
@pytest.mark.parametrize("sample,seed", [(homonym_sample, 7), (level_sample, 8)])
def test_assigned_parents_equal_plain_loops(monkeypatch, spark, sample, seed, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    records, nodes = sample(seed, 150, 80)
    first = loop_homonyms(records, nodes, S.PARENT_KINGDOMS)
    waiting = [r for r in records if r["speciesID"] not in first]
    second = {}
    for record_id, level, parent in loop_levels(waiting, nodes, S.PARENT_KINGDOMS):
        second.setdefault((record_id, level), []).append(parent)
    want = [(r, "first", None, 1, p) for r, p in first.items()]
    want += [(r, "second", v, len(p), min(p)) for (r, v), p in second.items()]
    done = {w[0] for w in want}
    want += [(r["speciesID"], "none", None, 0, None) for r in records if r["speciesID"] not in done]
    got = assign_parents(store(records_frame(spark, records), "records"), nodes_frame(spark, nodes))
    assert rows(got.select("speciesID", "stage", "level", "n_parents", "parentNameUsageID")) == sorted(want, key=repr)


def cleaned_sample(spark):
    raw = frame(spark, [{"taxonName": "x", "data cleanup changes": "y", "domain ": "d", **r} for r in RAW], RAW_DDL)
    return clean_records(raw, log_columns=["data cleanup changes 1"])


def test_options_reach_the_job(spark):
    cleaned, nodes = cleaned_sample(spark), nodes_frame(spark, NODES)
    got = match_checklist(cleaned, nodes, on_ambiguous="accepted_backed", generic_name="record")
    assert rows(got["exact"].select("speciesID", "matched_taxonID", "genericName")) == [("a1", 2, "Aus"), ("e1", 1, "Aus")]
    assert rows(got["ambiguous"].select("speciesID")) == [("d1",), ("d1",)]
    got = match_checklist(cleaned, nodes, tie_rank=None)
    assert parents(got["first_matches"]) == [("h1", 4)]
    got = match_checklist(cleaned, nodes, extra_keys=["kingdom"], labels={"taxonRank": "r", "taxonomicStatus": "s"})
    assert parents(got["second_matches_genus"]) == [("g1", 7), ("g1", 8)]
    assert rows(got["remainder"].select("taxonRank", "taxonomicStatus").distinct()) == [("r", "s")]
    for wrong in ({"on_ambiguous": "all"}, {"generic_name": "both"}):
        with pytest.raises(ValueError, match="must be"):
            match_checklist(cleaned, nodes, **wrong)


def test_all_stored_tables_go_to_the_given_folder(spark, tmp_path):
    before = set(os.listdir(shared_dir(spark)))
    match_checklist(cleaned_sample(spark), nodes_frame(spark, NODES), base=str(tmp_path / "job"))["remainder"].count()
    assert set(os.listdir(shared_dir(spark))) == before
    assert os.listdir(tmp_path / "job")


def test_levels_with_within_must_start_at_the_lowest_rank(spark):
    odd = S.Level(name="odd", keys=("order",), filled=("order", "family"), blank=S.RANKS[:3], within=("class",))
    with pytest.raises(ValueError, match="lowest rank"):
        assign_parents(records_frame(spark, [record("1", kingdom="Animalia")]), nodes_frame(spark, NODES), levels=[odd])


def test_a_local_session_needs_no_folder(monkeypatch, spark):
    monkeypatch.setattr(session, "shared_dir", lambda _: None)
    df = spark.range(5)
    stored = store(df, "x")
    assert stored.is_cached and rows(stored) == rows(df)
    stored.unpersist()


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_tables_keep_schema_and_rows(spark):
    df = records_frame(spark, [record("1", kingdom="Animalia")]).withColumn("n", F.lit(None).cast("long"))
    stored = store(df, "x")
    assert stored.schema == df.schema and rows(stored) == rows(df)


def test_counts_taken_while_storing_equal_counts_of_the_results(spark, results):
    again = match_summary(**{name: results[name] for name in ("unmatched", *RESULTS)})
    assert rows(summarise(results)) == rows(again)
    first = match_checklist(cleaned_sample(spark), nodes_frame(spark, NODES), multi="first")
    assert rows(summarise(first)) == rows(match_summary(**{n: first[n] for n in ("unmatched", *RESULTS)}))
    with pytest.raises(ValueError, match="multi"):
        match_checklist(cleaned_sample(spark), nodes_frame(spark, NODES), multi="some")


def test_a_result_computes_only_what_it_needs(spark, tmp_path):
    got = match_checklist(cleaned_sample(spark), nodes_frame(spark, NODES), base=str(tmp_path))
    stages = lambda: {p.rsplit("-", 1)[0] for p in os.listdir(tmp_path)}
    got["exact"].count()
    assert "candidates" in stages() and not {"unmatched", "assigned", "leveled"} & stages()
    got["remainder"].count()
    assert "assigned" in stages() and "leveled" not in stages()
    got["second_matches"].count()
    assert "leveled" in stages() and set(got) == {"exact", "ambiguous", "unmatched", *RESULTS}


def test_written_results_are_read_back(spark, results, tmp_path):
    write_results(results, str(tmp_path / "out"))
    back = read_results(spark, str(tmp_path / "out"))
    for name in RESULTS:
        own = back.where(F.col("result") == name).drop("result")
        assert rows(own) == rows(results[name].select(*own.columns))
    # Rows of several results are in several folders, and all come from one write.
    assert sorted(p for p in os.listdir(tmp_path / "out") if "=" in p) == sorted(f"result={n}" for n in RESULTS)


@pytest.mark.parametrize("sample,seed", [(homonym_sample, 17), (level_sample, 18)])
def test_inspected_parents_are_those_of_the_whole_job(spark, sample, seed):
    records, nodes = sample(seed, 150, 80)
    table, backbone = store(records_frame(spark, records), "records"), nodes_frame(spark, nodes)
    whole = assign_parents(table, backbone)
    test = F.col("family") != ""
    got = inspect_parents(table, backbone, ["speciesID", "stage", "parentNameUsageID"], test, ["speciesID"])
    assert rows(got) == rows(whole.where(test).select(*got.columns))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The filter lies below the joins that look parents up.
    assert plan.index("Join") < plan.index("Filter")


def test_observed_measures_equal_aggregates(monkeypatch, spark):
    df = spark.range(50).withColumn("a b", F.when(F.col("id") % 3 == 0, F.col("id")))
    measures = {"x.y": F.count("`a b`"), "rows": F.count("*")}
    for shared in (shared_dir(spark), None):
        monkeypatch.setattr(session, "shared_dir", lambda _, shared=shared: shared)
        stored, got = store_observed(df, "watched", measures)
        assert got == {"x.y": 17, "rows": 50} and rows(stored) == rows(df)
        assert store_observed(df, "watched", {})[1] == {}
        assert os.path.isdir(os.path.dirname(working_folder(spark, "x")))


def test_small_tables_are_dealt_out_and_large_ones_are_not(spark, tmp_path):
    df = spark.range(4000).withColumn("x y", F.lit("v")).coalesce(1)
    df.write.parquet(str(tmp_path / "one"))
    read = spark.read.parquet(str(tmp_path / "one"))
    dealt = spread(read)
    assert "Repartition" in dealt._jdf.queryExecution().optimizedPlan().toString() and rows(dealt) == rows(read)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        assert spread(read) is read
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_to_be_multiplied_are_dealt_out_by_their_number(spark):
    one = spark.range(1000, numPartitions=1)
    dealt = deal(one, rows=100)
    assert dealt.rdd.getNumPartitions() == 10 and rows(dealt) == rows(one)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 200
    assert deal(one, rows=1000).rdd.getNumPartitions() == 1


def test_the_nodes_are_made_in_several_tasks(monkeypatch, spark):
    from rankmatch.plans import tables

    parts = spark.range(1, 400).select(
        F.col("id").alias("p_partkey"), F.lit("red ring").alias("p_name"), F.lit("Brand#11").alias("p_brand"),
        F.lit("PROMO").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"),
    )
    monkeypatch.setattr(tables, "table", lambda *_: parts.coalesce(1))
    monkeypatch.setattr(session, "DEALT_ROWS", 50)
    plan = tables.backbone(spark, "")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and ", 8" in plan


def test_lines_are_shuffled_without_the_values_that_are_only_tested(spark, tmp_path):
    from rankmatch.plans import tables

    line = "1 l_orderkey, 1 l_partkey, 3 l_linenumber, 0.0D l_discount, 0.08D l_tax, 'R' l_returnflag, 'F' l_linestatus"
    spark.sql(f"SELECT {line}").write.parquet(str(tmp_path / "lineitem.parquet"))
    part = "1 p_partkey, 'red ring' p_name, 'Brand#11' p_brand, 'PROMO' p_type, 7 p_size"
    spark.sql(f"SELECT {part}").write.parquet(str(tmp_path / "part.parquet"))
    raw = tables.raw_checklist(spark, str(tmp_path))
    row = raw.first()
    assert (row["phylum"], row["class"], row["order"]) == ("  Brand#11 ", None, "ring Brand#11")
    join = raw._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert "AS is_misspelt" in join and "AS has_class" in join


def test_stored_tables_are_packed(spark, tmp_path):
    store(spark.range(10), "x", str(tmp_path)).count()
    assert glob.glob(f"{tmp_path}/x-*/*.zstd.parquet")
