import glob

import pytest
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.operators.levels import rank_backbone, rank_match
from rankmatch.sources import read_backbone, read_backbone_checked, read_records, write_csv
from rankmatch.sources.files import string_schema
from tests.helpers import node, nodes_frame

def lines(folder):
    out = []
    for part in glob.glob(f"{folder}/part-*"):
        with open(part, encoding="utf-8") as f:
            out += f.read().splitlines()[1:]
    return sorted(out)


def test_csv_keeps_empty_apart_from_null_and_headers_apart_by_case(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('speciesId,Data cleanup changes,data cleanup changes,x y\n1,,"", a\tb \n2,"say ""hi""","a,b",\n')
    df = read_records(spark, str(path), ids=["speciesId"])
    assert df.columns == ["speciesId", "Data cleanup changes", "data cleanup changes", "x y"]
    assert [tuple(r) for r in df.orderBy("speciesId").collect()] == [
        (1, None, "", " a\tb "),
        (2, 'say "hi"', "a,b", None),
    ]


def test_csv_needs_case_sensitive_names(spark, tmp_path):
    spark.conf.set("spark.sql.caseSensitive", "false")
    try:
        with pytest.raises(ValueError, match="caseSensitive"):
            read_records(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.caseSensitive", "true")


def test_csv_round_trip_is_exact(spark, tmp_path):
    path, out = tmp_path / "in.csv", tmp_path / "out"
    body = ['1,,"",plain', '2, lead ,"say ""hi""","a,b"', '3,"","",']
    path.write_text("\n".join(["a,b,c,d", *body]) + "\n")
    write_csv(read_records(spark, str(path)), str(out))
    assert lines(out) == sorted(body)


def test_tsv_has_no_quoting(spark, tmp_path):
    path = tmp_path / "in.tsv"
    path.write_text('taxonID\tacceptedNameUsageID\tcanonicalName\tgenus\n1\t\t"Aus\tBus\n2\t1\tin"ner\tC\\us\n3\t\t\t"D"\n')
    df = read_backbone(spark, str(path))
    assert [tuple(r) for r in df.orderBy("taxonID").collect()] == [
        (1, None, '"Aus', "Bus"),
        (2, 1, 'in"ner', "C\\us"),
        (3, None, None, '"D"'),
    ]


def test_malformed_id_raises(spark, tmp_path):
    path = tmp_path / "in.tsv"
    path.write_text("taxonID\tacceptedNameUsageID\nx1\t\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_backbone(spark, str(path)).collect()


def test_void_columns_can_be_written(spark, tmp_path):
    write_csv(spark.range(1).withColumn("n", F.lit(None)), str(tmp_path / "out"))
    assert lines(tmp_path / "out") == ["0,"]


# The accepted phyla that the records of the test point to.
PHYLA = {"Sipuncula": 74, "Porifera": 105, "Nemertea": 63}


def phylum_lines(parent):
    """CSV lines of 168 records that have a phylum only, ids unquoted and empty strings quoted."""
    found = []
    for i in range(168):
        phylum = list(PHYLA)[i % 3]
        values = {c: '""' for c in S.OUTPUT_COLUMNS}
        values.update({S.MATCHED_ID: "", S.ACCEPTED_ID: "", S.RECORD_ID: f"r{i}", "taxonName": f'"{phylum}, number {i}"'})
        values.update({"domain": "Eukarya", "kingdom": "Animalia", "phylum": phylum, **S.UNMATCHED_LABELS})
        values[S.PARENT_ID] = str(PHYLA[phylum]) if parent else ""
        found.append(",".join(values[c] for c in S.OUTPUT_COLUMNS))
    return found


def test_phylum_level_writes_the_expected_file(spark, tmp_path):
    path = tmp_path / "records.csv"
    path.write_text("\n".join([",".join(S.OUTPUT_COLUMNS), *phylum_lines(parent=False)]) + "\n")
    records = read_records(spark, str(path), ids=[S.MATCHED_ID, S.ACCEPTED_ID, S.PARENT_ID])
    nodes = [node(i, p, "phylum", kingdom="Animalia", phylum=p) for p, i in PHYLA.items()]
    nodes += [node(900, "Porifera", "class", kingdom="Animalia", phylum="Porifera", class_="Calcarea")]
    found = rank_match(records, rank_backbone(nodes_frame(spark, nodes)))
    write_csv(found.select(*[f"`{c}`" for c in S.OUTPUT_COLUMNS]), str(tmp_path / "out"))
    assert lines(tmp_path / "out") == sorted(phylum_lines(parent=True))


LINES = ["1\t\t\"Aus\tBus", "2\t1\tx", "z3\t\ty\tq", "4\t5\tok\tC\\us\tmore", "5\t 7x\ta\tb", "99999999999999999999\t\ta\tb", "\t\ta\tb"]
REJECTED = [
    ("2\t1\tx", "columns"),
    ("4\t5\tok\tC\\us\tmore", "columns"),
    ("5\t 7x\ta\tb", "id acceptedNameUsageID"),
    ("99999999999999999999\t\ta\tb", "id taxonID"),
    ("z3\t\ty\tq", "id taxonID"),
]


@pytest.mark.parametrize("header", [True, False])
def test_malformed_lines_are_rejects(spark, tmp_path, header):
    names = ["taxonID", "acceptedNameUsageID", "canonicalName", "genus"]
    path = tmp_path / "in.tsv"
    path.write_text("\n".join((["\t".join(names)] if header else []) + LINES) + "\n")
    nodes, rejects = read_backbone_checked(spark, str(path), None if header else string_schema(names), header=header)
    assert sorted((tuple(r) for r in nodes.collect()), key=repr) == [(1, None, '"Aus', "Bus"), (None, None, "a", "b")]
    assert sorted(map(tuple, rejects.collect())) == REJECTED
    # One column alone is right as well, though fewer columns are parsed then.
    assert nodes.select("genus").count() == 2 and rejects.select("reason").count() == 5
    if not header:
        with pytest.raises(ValueError, match="schema"):
            read_backbone_checked(spark, str(path), header=False)
