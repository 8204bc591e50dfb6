import random

import pytest

from rankmatch.operators import homonyms
from tests.helpers import RANKS, frame, loop_homonyms, node, nodes_frame, record, records_frame, rows

KINGDOMS = ("Animalia", "Plantae")
FIVE = ["epithet", "genus", "family", "phylum", "kingdom"]
SIX = ["phylum", "family", "genus", "epithet"]


def five_node(i, kingdom, phylum, family, genus, epithet, name):
    return {
        "taxonID": i, "taxonomicStatus": "accepted", "canonicalName": name, "kingdom": kingdom, "phylum": phylum,
        "family": family, "genus": genus, "epithet": epithet,
    }


NODES = [
    five_node(1, "Animalia", "P1", "F1", "Aus", None, "Aus"),
    five_node(2, "Animalia", "P2", "F2", "Aus", None, "Aus"),
    five_node(3, "Animalia", "P1", "F1", "Bus", None, "Bus"),
    five_node(4, "Animalia", "P1", "F1", "Bus", "x", "Bus"),
    five_node(5, "Animalia", "P1", "F3", None, None, "F3"),
    five_node(6, "Plantae", "P9", "F3", None, None, "F3"),
    five_node(7, "Animalia", "P1", "F1", "Cus", "c", "Cus"),
    five_node(8, "Animalia", "P1", "F1", "Cus", "d", "Cus"),
    five_node(9, "Animalia", "P1", "F1", "Dus", None, "Dus"),
]
NODE_DDL = "taxonID long, taxonomicStatus string, canonicalName string, kingdom string, phylum string, family string, genus string, epithet string"
RECORD_DDL = "speciesID string, kingdom string, phylum string, family string, genus string, epithet string"


def five_record(i, phylum, family, genus="", epithet=""):
    return {"speciesID": i, "kingdom": "Animalia", "phylum": phylum, "family": family, "genus": genus, "epithet": epithet}


RECORDS = [
    five_record("101", "P2", "F2", "Aus"),
    five_record("102", "P1", "F1", "Bus"),
    five_record("103", "P1", "F3"),
    five_record("104", "P1", "F1", "Cus"),
    five_record("105", "P1", "F1", "Dus"),
    five_record("106", "P1", "F1", "Bus", "q"),
]


def assign(spark, records):
    found = homonyms.homonym_assign(
        frame(spark, records, RECORD_DDL), frame(spark, NODES, NODE_DDL), KINGDOMS, FIVE, "genus", SIX
    )
    return {r.speciesID: r.parentNameUsageID for r in found.collect()}


def test_single_record_takes_the_node_that_equals_it(spark):
    assert assign(spark, RECORDS) == {"101": 2, "102": 3, "103": 5}


def test_two_records_take_the_first_node(spark):
    got = assign(spark, [*RECORDS, five_record("107", "P2", "F2", "Aus")])
    assert got == {"101": 1, "107": 1, "102": 3, "103": 5}


def test_names_without_qualifying_node_are_reported(spark):
    got = homonyms.unresolvable_homonyms(
        frame(spark, RECORDS, RECORD_DDL), frame(spark, NODES, NODE_DDL), KINGDOMS, FIVE
    )
    assert rows(got) == [("genus", "Cus", 1)]


def sample(seed, n_records, n_nodes):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(6)]

    def path(absent):
        """Ranks from the kingdom down to a random depth, with some holes."""
        depth = rng.randint(1, 8)
        out = {}
        for i, r in enumerate(reversed(RANKS)):
            value = rng.choice(KINGDOMS + ("Fungi",)) if r == "kingdom" else rng.choice(words)
            out[r] = value if i < depth and rng.random() > 0.1 else absent
        return out

    nodes = []
    for i in range(n_nodes):
        p = path(None)
        values = [v for v in p.values() if v and v.startswith("W")] or [None]
        nodes.append(
            {**node(i + 1, rng.choice([*values, "odd", "", None]), rng.choice(["x", "unranked"])), **p,
             "taxonomicStatus": rng.choice(["accepted", "accepted", "synonym"])}
        )
    records = [{**record(f"r{i}"), **path("")} for i in range(n_records)]
    return records, nodes


# Few records make lone targets, many make shared ones.
@pytest.mark.parametrize("seed,n_records,n_nodes", [(1, 25, 60), (2, 25, 60), (3, 300, 80), (4, 60, 60)])
def test_assignment_equals_a_plain_loop(spark, seed, n_records, n_nodes):
    records, nodes = sample(seed, n_records, n_nodes)
    found = homonyms.homonym_assign(records_frame(spark, records), nodes_frame(spark, nodes))
    got = {r.speciesID: r.parentNameUsageID for r in found.collect()}
    assert got == loop_homonyms(records, nodes, KINGDOMS)
    assert got


def test_groups_features_and_picks(spark):
    names = homonyms.accepted_names(frame(spark, NODES, NODE_DDL), KINGDOMS, FIVE)
    assert [r.taxonID for r in homonyms.homonym_groups(names).orderBy("taxonID").collect()] == list(range(1, 9))
    features = homonyms.homonym_features(names, FIVE)
    assert rows(features.select("canonicalName", "features_text")) == [
        ("Aus", "genus"), ("Bus", "genus"), ("Cus", "genus"), ("F3", "family"),
    ]
    picks = {(r.canonicalName, r.rank): (r.chosen_id, r.other_id) for r in homonyms.homonym_picks(homonyms.homonym_table(names, FIVE), FIVE).collect()}
    assert picks[("Aus", "genus")] == (1, 2)
    assert picks[("F3", "family")] == (5, 6)
    assert ("Cus", "genus") not in picks


def test_features_are_listed_finest_first(spark):
    nodes = [
        node(1, "X", kingdom="Animalia", family="X", genus="X"),
        node(2, "X", kingdom="Animalia", order="X"),
        node(3, "Y", kingdom="Animalia"),
        node(4, "Y", kingdom="Animalia"),
    ]
    names = homonyms.accepted_names(nodes_frame(spark, nodes))
    assert rows(homonyms.homonym_features(names)) == [("X", "genus, family, order", ["genus", "family", "order"])]


def test_large_groups_are_cut_before_the_shuffle(spark):
    names = homonyms.accepted_names(nodes_frame(spark, [node(1, "A", kingdom="Animalia")]))
    plan = homonyms.first_two(names)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
