"""What is shuffled, stored and written no wider or more often than the results need."""

import glob
from functools import partial

import pytest
from pyspark.sql import functions as F

from rankmatch.operators import joins, levels
from rankmatch.plans import flow, tables
from rankmatch.session import store
from rankmatch.sources.files import read_records, string_schema, write_csv
from tests.helpers import node, nodes_frame, record, records_frame, rows


@pytest.fixture(scope="module")
def ids(spark):
    """Ids of which some come twice, one very often, and some rows have none."""
    number = F.when(F.col("id") < 900, F.col("id")).when(F.col("id") < 1200, F.col("id") - 900)
    key = number.cast("string")
    return spark.range(1400).select(F.col("id").alias("n"), F.when(F.col("id") < 1300, F.coalesce(key, F.lit("hot"))).alias("id"))


@pytest.mark.parametrize("bits", [64, 1024, 1 << 12, 1 << 25])
@pytest.mark.parametrize("most", [64, 1 << 28])
def test_repeated_ids_are_marked_exactly_by_filters_of_any_size(monkeypatch, ids, bits, most):
    monkeypatch.setattr(joins, "FILTER_BITS", bits)
    monkeypatch.setattr(joins, "MOST_FILTER_BITS", most)
    got = joins.flag_repeated(ids, "id", join=partial(joins.attach, limit=0))
    expected = sorted((n, n < 300 or n >= 900) for n in range(1400))
    assert rows(got.select("n", "is_repeated")) == sorted(expected, key=repr)


def test_rows_that_two_filters_tell_are_not_shuffled(monkeypatch, spark):
    monkeypatch.setattr(joins, "FILTER_BITS", 1 << 13)
    df = spark.range(4000).select((F.col("id") % 3000).cast("string").alias("id"), F.col("id").alias("n"))
    plan = joins.flag_repeated(df, "id", join=partial(joins.attach, limit=0))._jdf.queryExecution().optimizedPlan().toString()
    # Both filters for the rows that are shuffled and for the others, the second for the repeated keys.
    assert plan.count("Relation [__word#") == 5
    # The second filter's hash is another one: of the repeated keys few pass it.
    twice = df.where("n < 1000").select("id")
    once = joins.maybe_in(df.where("n >= 1000 AND n < 3000"), joins.key_filter(twice, ["id"]), ["id"])
    passed = joins.maybe_in(twice, joins.key_filter(once, ["id"], seed=1), ["id"], seed=1).count()
    assert 50 < once.count() < 600 and passed < 200


def _broadcasts(df):
    """(bytes, how many joins use it) of every filter that was broadcast for a result."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), {}

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ReusedExchangeExec":
            return walk(node.child())
        if kind == "BroadcastExchangeExec" and "__word#" in node.output().toString():
            size, uses = node.metrics().apply("dataSize").value(), found.get(node.id(), (0, 0))[1]
            found[node.id()] = (size, uses + 1)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sorted(found.values())


def test_a_filter_takes_little_more_than_its_bits_in_the_driver(spark):
    bits = 1 << 24
    words = store(joins.key_filter(spark.range(1_000_000), ["id"], bits), "words")
    kept = joins.maybe_in(spark.range(990_000, 1_010_000), words, ["id"], bits)
    # A row for each long of 64 bits took over four times the two MB; pages are doubled, so up to twice the rows' size is taken.
    assert [size < 2.5 * bits / 8 for size, _ in _broadcasts(kept)] == [True]
    # Whether a key passes is told bit by bit.
    at = joins._bit(["id"], bits, 0).alias("at")
    bit = spark.range(1_000_000).select(at).distinct()
    assert rows(kept) == rows(spark.range(990_000, 1_010_000).select("id", at).join(bit, "at", "left_semi").select("id"))
    assert words.count() == 4096 and joins._set_bits(words) == bit.count()


def test_each_filter_is_broadcast_once(monkeypatch, spark):
    monkeypatch.setattr(joins, "FILTER_BITS", 1 << 14)
    df = store(spark.range(4000).select((F.col("id") % 3000).cast("string").alias("id"), F.col("id").alias("n")), "ids")
    found = _broadcasts(joins.flag_repeated(df, "id", join=partial(joins.attach, limit=0)))
    # One filter has the rows that are shuffled and the others, one also the repeated keys.
    assert sorted(uses for _, uses in found) == [2, 3]


def test_records_that_look_for_no_parent_are_not_shuffled(spark):
    records = records_frame(spark, [record("a", phylum="P"), record("b", phylum="Q"), record("c")])
    nodes = nodes_frame(spark, [node(1, phylum="P")])
    plan = levels.count_parents(records, nodes, join=partial(joins.attach, limit=0))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan


def test_answers_are_packed_with_the_unknown_ones(spark):
    answers = [(a, b, c) for a in (True, False, None) for b in (True, False, None) for c in (True, False, None)]
    df = spark.createDataFrame(answers, "a boolean, b boolean, c boolean")
    packed = df.select("*", tables._packed([F.col(c) for c in "abc"]).alias("tests"))
    got = packed.select(*[tables._unpacked("tests", i) for i in range(3)])
    assert rows(got) == sorted(answers, key=repr)


def test_candidates_are_not_stored_for_results_that_do_not_read_them(spark, tmp_path):
    filled = [record("p1", phylum="P"), record("e1", genus="G", specificEpithet="s"), record("n1", phylum="Q")]
    cleaned = records_frame(spark, filled).withColumnRenamed("speciesID", "speciesId").withColumn("taxonName", F.lit("G s"))
    kingdom = {"kingdom": "Animalia"}
    bb = nodes_frame(spark, [node(1, phylum="P", **kingdom), node(2, genus="G", specificEpithet="s", **kingdom)])
    results = flow.match_checklist(cleaned, bb, base=str(tmp_path))
    rest = rows(results["remainder"])
    assert not glob.glob(f"{tmp_path}/candidates-*")
    other = flow.match_checklist(cleaned, bb, base=str(tmp_path))
    assert other["exact"].count() == 1 and rows(other["remainder"]) == rest
    assert len(glob.glob(f"{tmp_path}/candidates-*")) == 1


def test_compressed_csv_reads_the_same(spark, tmp_path):
    df = spark.createDataFrame([("a", "", None), ('q"u', " x ", "y,z")], "a string, b string, c string")
    for codec in ("none", "gzip"):
        write_csv(df, f"{tmp_path}/{codec}", compression=codec)
        back = read_records(spark, f"{tmp_path}/{codec}", string_schema(df.columns))
        assert rows(back) == rows(df)
    assert glob.glob(f"{tmp_path}/gzip/*.csv.gz") and glob.glob(f"{tmp_path}/none/*.csv")
