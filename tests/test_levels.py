import random

import pytest
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.ranks import presence_mask
from rankmatch.operators import joins, levels
from tests.helpers import COARSE, loop_levels, node, nodes_frame, record, records_frame, rows

KINGDOMS = S.PARENT_KINGDOMS


def sample(seed, n_records=150, n_nodes=120):
    rng = random.Random(seed)

    def path(absent):
        depth = rng.randint(1, 8)
        out = {}
        for i, r in enumerate(COARSE):
            value = rng.choice(["Animalia", "Plantae", "Fungi"]) if r == "kingdom" else f"{r[:3]}{rng.randint(0, 2)}"
            out[r] = value if i < depth and rng.random() > 0.05 else absent
        return out

    nodes = [
        {**node(i + 1, None, rng.choice(["species", "genus", "unranked", None])), **path(None),
         "taxonomicStatus": rng.choice(["accepted", "accepted", "synonym"])}
        for i in range(n_nodes)
    ]
    return [{**record(f"r{i}"), **path("")} for i in range(n_records)], nodes


@pytest.mark.parametrize("join", [joins.lookup, joins.attach])
@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_and_counts_equal_a_plain_loop(spark, seed, join):
    records, nodes = sample(seed)
    want = loop_levels(records, nodes, KINGDOMS)
    assert {w[1] for w in want} == {v.name for v in S.LEVELS}
    df, pool = records_frame(spark, records), levels.rank_backbone(nodes_frame(spark, nodes))
    pairs = levels.rank_match(df, pool, keep_level=True, join=join)
    assert rows(pairs.select("speciesID", "level", "parentNameUsageID")) == sorted(want, key=repr)

    per_record = {}
    for record_id, level, parent in want:
        per_record.setdefault((record_id, level), []).append(parent)
    counted = levels.count_parents(df, pool, join=join).where("n_parents > 0")
    assert rows(counted.select("speciesID", "level", "n_parents", "first_parent")) == sorted(
        ((r, v, len(p), min(p)) for (r, v), p in per_record.items()), key=repr
    )
    first = levels.rank_match(df, pool, multi="first", join=join)
    assert rows(first.select("speciesID", "parentNameUsageID")) == sorted(
        ((r, min(p)) for (r, _), p in per_record.items()), key=repr
    )


def test_each_level_alone_equals_its_part(spark):
    records, nodes = sample(3)
    want = loop_levels(records, nodes, KINGDOMS)
    df, pool = records_frame(spark, records), levels.rank_backbone(nodes_frame(spark, nodes))
    for level in S.LEVELS:
        got = levels.rank_match(df, pool, [level]).select("speciesID", "parentNameUsageID")
        assert rows(got) == sorted([(r, p) for r, v, p in want if v == level.name], key=repr)


def test_levels_exclude_one_another(spark):
    records, _ = sample(4, 500)
    df = records_frame(spark, records)
    hits = sum(presence_mask(v.filled, v.blank).cast("int") for v in S.LEVELS)
    assert df.where(hits > 1).count() == 0


def test_record_with_a_hole_stays_unmatched(spark):
    df = records_frame(spark, [record("1", kingdom="Animalia", phylum="P", order="O")])
    pool = levels.rank_backbone(nodes_frame(spark, [node(1, None, "order", kingdom="Animalia", order="O")]))
    assert levels.rank_match(df, pool).count() == 0


def test_family_needs_an_order_seen_among_the_records(spark):
    records = [
        record("1", kingdom="Animalia", phylum="P", class_="C", order="O1", family="F"),
        record("2", kingdom="Animalia", phylum="P", class_="C", order="O2", family="G"),
    ]
    nodes = [
        node(1, None, "family", kingdom="Animalia", order="O2", family="F"),
        node(2, None, "family", kingdom="Animalia", order="O3", family="F"),
        node(3, None, "family", kingdom="Animalia", family="F"),
    ]
    got = levels.rank_match(records_frame(spark, records), levels.rank_backbone(nodes_frame(spark, nodes)))
    # The order is tested on its own: O2 comes from another record.
    assert rows(got.select("speciesID", "parentNameUsageID")) == [("1", 1)]


def test_extra_keys_must_agree(spark):
    records = [record("1", kingdom="Plantae", phylum="P")]
    nodes = [node(1, None, "phylum", kingdom="Animalia", phylum="P"), node(2, None, "phylum", kingdom="Plantae", phylum="P")]
    df, pool = records_frame(spark, records), levels.rank_backbone(nodes_frame(spark, nodes))
    assert levels.rank_match(df, pool).count() == 2
    assert rows(levels.rank_match(df, pool, extra_keys=["kingdom"]).select("parentNameUsageID")) == [(2,)]


def test_unmatched_names(spark):
    df = records_frame(
        spark, [record(str(i), kingdom="Animalia", phylum="P") for i in range(3)] + [record("9", kingdom="Animalia")]
    )
    assert rows(levels.unmatched_names(df)) == [("phylum", "P", "", 3)]


def test_a_rank_that_is_null_is_neither_filled_nor_blank(spark):
    filled = {c: "x" for c in ("kingdom", "phylum", "class", "order")}
    odd = [record("whole", **filled), {**record("gap", **filled), "family": None}, {**record("bare"), "phylum": None}]
    got = levels.record_levels(records_frame(spark, odd)).select("speciesID", *levels.level_columns())
    assert rows(got.where("level IS NOT NULL")) == [("whole", "order", "x", "")]


def test_ranks_are_tested_once(spark):
    """A test per level and rank makes a method the JVM does not compile."""
    sql = levels._level_sql(S.LEVELS, ())
    assert all(sql.count(f"`{r}` <> ''") == 1 for r in S.RANKS[:7])
    many = [S.Level(name="m", keys=("c0",), filled=("c0",), blank=tuple(f"c{i}" for i in range(1, 40)))]
    row = spark.range(1).select(*[F.lit("" if i else "v").alias(f"c{i}") for i in range(40)])
    assert levels.record_levels(row, many).select("level_key.level").first()[0] == "m"
