import pytest
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.operators import clean
from rankmatch.sources import read_records
from tests.helpers import frame, rows

LOGS = [c for c in S.LOG_COLUMNS if c != "data cleanup changes 1"]
HEADER = ["speciesId", "taxonName", "domain ", "phylum", "class", "genus", "species", "subspecies", "tribe", "blank",
          "data cleanup changes", *LOGS, "Unnamed: 3"]


def raw(spark, tmp_path, records):
    body = [",".join(HEADER)]
    for r in records:
        full = {"blank": "  ", **{c: "x" for c in ["data cleanup changes", *LOGS, "Unnamed: 3"]}, **r}
        body.append(",".join(full.get(c, "") for c in HEADER))
    path = tmp_path / "raw.csv"
    path.write_text("\n".join(body) + "\n")
    return read_records(spark, str(path))


def test_clean_records(spark, tmp_path):
    df = clean.clean_records(
        raw(
            spark,
            tmp_path,
            [
                {"speciesId": "1", "taxonName": " <i>Aus bus</i> ", "phylum": " Chordata ", "genus": " Aus", "species": "bus "},
                {"speciesId": "2", "taxonName": "Aus", "phylum": "Ascomycota", "subspecies": "cus"},
                {"speciesId": "3", "taxonName": "Aus", "phylum": "Cyanobacteria"},
                {"speciesId": "4", "taxonName": "Aus", "phylum": "Ciliophora"},
                {"speciesId": "5", "taxonName": "Aus"},
            ],
        )
    )
    # Wholly empty columns go unless they are ranks, a column of blanks stays, logs go.
    assert set(df.columns) == {
        "speciesId", "taxonName", "domain", "phylum", "class", "genus", "specificEpithet", "infraspecificEpithet",
        "blank", "genericName", "kingdom",
    }
    got = df.orderBy("speciesId").select(
        "taxonName", "domain", "phylum", "genus", "specificEpithet", "infraspecificEpithet", "genericName", "kingdom", "blank"
    )
    assert [tuple(r) for r in got.collect()] == [
        ("Aus bus", "Eukarya", "Chordata", "Aus", "bus", "", "Aus", "Animalia", ""),
        ("Aus", "Eukarya", "Ascomycota", None, None, "cus", None, "fungi", ""),
        ("Aus", "Eukarya", "Cyanobacteria", None, None, "", None, "Bacteria", ""),
        ("Aus", "Eukarya", "Ciliophora", None, None, "", None, "Protista", ""),
        ("Aus", "Eukarya", None, None, None, "", None, "Animalia", ""),
    ]


def test_every_correction_rule(spark):
    found = [
        {"genericName": g, "specificEpithet": old, "infraspecificEpithet": "", "want": new}
        for g, old, new in S.EPITHET_CORRECTIONS
    ]
    found += [{"genericName": "Other", "specificEpithet": "edwardsi", "infraspecificEpithet": "", "want": "edwardsi"}]
    df = frame(spark, found, "genericName string, specificEpithet string, infraspecificEpithet string, want string")
    got = clean.apply_corrections(df, S.default_corrections()).collect()
    assert all(r.specificEpithet == r.want for r in got)
    assert {r.genericName: r.infraspecificEpithet for r in got if r.infraspecificEpithet} == {"Glenea": "mathematica"}


def test_correction_table_equals_rules(spark):
    df = frame(
        spark,
        [{"g": "A", "e": "x"}, {"g": "A", "e": "y"}, {"g": None, "e": "x"}, {"g": "B", "e": None}],
        "g string, e string",
    )
    rules = frame(spark, [{"g": "A", "e": "x", "corrected": "z"}, {"g": "A", "e": "x", "corrected": "zz"}], "g string, e string, corrected string")
    got = clean.correct_from_table(df, rules, ["g", "e"], "e")
    assert rows(got) == sorted([("A", "z"), ("A", "y"), (None, "x"), ("B", None)], key=repr)


def test_strict_rename_and_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `Unnamed: 1` int")
    with pytest.raises(ValueError, match="missing"):
        clean.rename_strict(df, {"z": "y"})
    with pytest.raises(ValueError, match="missing"):
        clean.drop_strict(df, ["z"])
    assert clean.drop_prefix(df, "Unnamed").columns == ["a"]


def test_null_profile_and_empty_columns(spark):
    df = frame(spark, [{"a": "x"}, {"b": ""}, {"a": "y"}], "a string, b string, `c.d` string")
    assert rows(clean.null_profile(df)) == [("a", 1), ("b", 2), ("c.d", 3)]
    assert clean.drop_all_null(df).columns == ["a", "b"]


def test_cast_ids(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "id string")
    assert rows(clean.cast_ids(df, ["id"], malformed="null")) == sorted([(1,), (None,), (None,)], key=repr)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.cast_ids(df, ["id"]).collect()


def test_derive_genus(spark):
    df = frame(
        spark,
        [
            {"genus": None, "specificEpithet": "b", "taxonName": "Aus bus"},
            {"genus": None, "specificEpithet": None, "taxonName": "Aus bus"},
            {"genus": "", "specificEpithet": "b", "taxonName": "Aus bus"},
        ],
        "genus string, specificEpithet string, taxonName string",
    )
    assert rows(clean.derive_genus(df).select("genus")) == sorted([("Aus",), (None,), ("",)], key=repr)


def test_fill_and_blank(spark):
    df = spark.createDataFrame([(None, None)], "a string, n long")
    filled = clean.fill_blank(df)
    assert [tuple(r) for r in filled.collect()] == [("", None)]
    assert clean.blank_to_null(filled, ["a"]).where(F.col("a").isNull()).count() == 1


def test_empty_columns_are_found_while_storing(spark):
    ddl = "speciesId string, taxonName string, `domain ` string, phylum string, `class` string, `order` string, family string,"
    ddl += " genus string, species string, subspecies string, `data cleanup changes` string, tribe string, `odd.name` string"
    blank = {"speciesId": "1", "domain ": "d", "data cleanup changes": "y", "odd.name": " "}
    raw = frame(spark, [blank, {**blank, "phylum": "P"}], ddl)
    options = {"log_columns": ["data cleanup changes 1"]}
    got, want = clean.clean_and_store(raw, **options), clean.clean_records(raw, **options)
    assert "tribe" not in got.columns and "odd.name" in got.columns and "family" in got.columns
    assert rows(got) == rows(want) and got.columns == want.columns
    assert clean.clean_and_store(raw.limit(0), **options).count() == 0


def test_types_are_inferred_from_all_rows(spark):
    values = [("1", "1", "1.5", "", "9223372036854775807", None), ("-2", "x", ".5e3", "1", "+7", None)]
    df = spark.createDataFrame(values, "a string, `b c` string, d string, e string, f string, g string")
    got = {r["feature"]: (r["n_values"], r["n_long"], r["n_double"], r["type"]) for r in clean.infer_types(df).collect()}
    assert got == {
        "a": (2, 2, 2, "long"), "b c": (2, 1, 1, "string"), "d": (2, 0, 2, "double"), "e": (2, 1, 1, "string"),
        "f": (2, 2, 2, "long"), "g": (0, 0, 0, "string"),
    }
    typed = clean.with_inferred_types(df)
    assert [f.dataType.simpleString() for f in typed.schema] == ["bigint", "string", "double", "string", "bigint", "string"]
    assert rows(typed) == sorted([(1, "1", 1.5, "", 2**63 - 1, None), (-2, "x", 500.0, "1", 7, None)], key=repr)
    # One value out of range, or one word at the end, makes another type.
    late = df.unionByName(spark.createDataFrame([("9223372036854775808", *[None] * 5)], df.schema))
    assert {r["feature"]: r["type"] for r in clean.infer_types(late).collect()}["a"] == "double"
