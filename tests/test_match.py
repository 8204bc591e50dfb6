import random

import pytest

from rankmatch import settings as S
from rankmatch.operators import match
from tests.helpers import frame, node, nodes_frame, rows

RECORD = "speciesId string, taxonName string, genus string, specificEpithet string, infraspecificEpithet string, genericName string"
KEEP = ["speciesID", "matched_taxonID", "acceptedNameUsageID", "genericName"]


def record(i, genus=None, epithet=None, infra="", name="Aus bus"):
    return {
        "speciesId": i, "taxonName": name, "genus": genus, "specificEpithet": epithet, "infraspecificEpithet": infra,
        "genericName": genus,
    }


def sample(seed, n_records=120, n_nodes=60):
    rng = random.Random(seed)
    nodes = [
        node(
            i + 1,
            rank=rng.choice(["species", "unranked", "subspecies", None]),
            status=rng.choice([*S.MATCHABLE_STATUSES, "doubtful"]),
            accepted=rng.choice([None, rng.randint(1, n_nodes)]),
            genus=rng.choice(["A", "B", "", None]),
            specificEpithet=rng.choice(["a", "b", "c", "", None]),
            infraspecificEpithet=rng.choice([None, None, "i"]),
        )
        for i in range(n_nodes)
    ]
    for n in nodes:
        n["genericName"] = f"G{n['taxonID']}"
    records = [
        record(
            rng.choice([None, *[f"r{j}" for j in range(n_records)]]),
            rng.choice(["A", "B", "C", None]),
            rng.choice(["a", "b", "c", "d", None]),
            rng.choice(["", "", "i"]),
        )
        for _ in range(n_records)
    ]
    return records, nodes


def loop_matches(records, nodes):
    usable = [
        n
        for n in nodes
        if n["taxonomicStatus"] in S.MATCHABLE_STATUSES
        and n["taxonRank"] not in (None, "unranked")
        and n["genus"]
        and n["specificEpithet"]
    ]
    out = []
    for r in records:
        hits = [
            n
            for n in usable
            if (n["genus"], n["specificEpithet"], n["infraspecificEpithet"] or "")
            == (r["genus"], r["specificEpithet"], r["infraspecificEpithet"])
        ]
        out += [(r["speciesId"], n["taxonID"], n["acceptedNameUsageID"], n["genericName"]) for n in hits]
        if not hits:
            out.append((r["speciesId"], None, None, None))
    return out


@pytest.mark.parametrize("seed", [2, 9])
def test_exact_match_and_ambiguity_equal_plain_loops(spark, seed):
    records, nodes = sample(seed)
    prepared = match.prepare_backbone(nodes_frame(spark, nodes))
    cleaned = frame(spark, records, RECORD)
    pairs = match.exact_match(cleaned, prepared)
    want = loop_matches(records, nodes)
    assert pairs.columns == list(S.MATCH_COLUMNS)
    assert rows(pairs.select(KEEP)) == sorted(want, key=repr)

    ids = [w[0] for w in want]
    single = [w for w in want if ids.count(w[0]) == 1]
    many = [w for w in want if ids.count(w[0]) > 1]
    kept, dropped = match.resolve_ambiguous(pairs)
    assert rows(kept.select(KEEP)) == sorted(single, key=repr)
    assert rows(dropped.select(KEEP)) == sorted(many, key=repr)

    backing = {w[2] for w in many if w[2] is not None}
    backed = [w for w in many if w[2] is None and w[1] in backing]
    rest = [w for w in many if w[0] is None or w[0] not in {b[0] for b in backed}]
    kept, dropped = match.resolve_ambiguous(pairs, on_ambiguous="accepted_backed")
    assert backed
    assert rows(kept.select(KEEP)) == sorted(single + backed, key=repr)
    assert rows(dropped.select(KEEP)) == sorted(rest, key=repr)

    # The counting form gives the same records without making pairs.
    found = match.candidates(cleaned, prepared, columns=None)
    matched, unmatched, ambiguous = match.split_candidates(found)
    assert rows(matched.select(KEEP)) == sorted([w for w in single if w[1] is not None], key=repr)
    assert rows(unmatched.select("speciesID")) == sorted([(w[0],) for w in single if w[1] is None], key=repr)
    assert matched.count() + unmatched.count() + ambiguous.count() == len(records)

    keyed = found.fillna("", ["infraspecificEpithet"])
    per_record = match.accepted_backed(keyed, prepared)
    assert per_record.agg({"n_backed": "sum"}).first()[0] == len(backed)
    assert {r.first_backed for r in per_record.collect()} <= {b[1] for b in backed}


def test_generic_name_can_be_the_records(spark):
    cleaned = frame(spark, [record("1", "A", "a")], RECORD)
    n = node(7, rank="species", genus="A", specificEpithet="a")
    n["genericName"] = "Old"
    prepared = match.prepare_backbone(nodes_frame(spark, [n]))
    assert match.exact_match(cleaned, prepared).first()["genericName"] == "Old"
    assert match.exact_match(cleaned, prepared, generic_name="record").first()["genericName"] == "A"


def test_genus_from_generic_name(spark):
    n = node(7, rank="species", specificEpithet="a")
    n["genericName"] = "A"
    df = nodes_frame(spark, [n])
    assert match.prepare_backbone(df).count() == 0
    assert match.prepare_backbone(df, genus_from_generic=True).first()["genus"] == "A"


def test_unmatched_are_labelled_and_blank_filled(spark):
    cleaned = frame(spark, [record("1", None, "x", name="Cus xus"), record("2", None, None)], RECORD)
    pairs = match.exact_match(cleaned, match.prepare_backbone(nodes_frame(spark, [])))
    out = match.unmatched(pairs)
    assert tuple(out.columns) == S.OUTPUT_COLUMNS
    got = {r.speciesID: r for r in out.collect()}
    assert got["1"].genus == "Cus" and got["2"].genus == ""
    assert got["1"].taxonRank == "BOSuncornirmedSpecies" and got["1"].taxonomicStatus == "BOSunformired"
    assert got["1"].tribe == "" and got["1"].infraspecificEpithet == "" and got["1"].genericName == ""
    assert got["1"].matched_taxonID is None and got["1"].parentNameUsageID is None
    assert dict(out.dtypes)["parentNameUsageID"] == "bigint"
