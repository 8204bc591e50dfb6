from pyspark.sql import functions as F

from rankmatch.functions import (
    blank_as_null,
    category,
    first_token,
    lowest_name,
    lowest_rank,
    null_as_blank,
    presence_mask,
    strip_markup,
    trim_blanks,
)
from tests.helpers import frame


def values(spark, column, inputs):
    df = frame(spark, [{"i": i, "x": x} for i, x in enumerate(inputs)], "i long, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_trim_cuts_blanks_only(spark):
    assert values(spark, trim_blanks, ["  a b ", "\ta\t ", "   ", "", None]) == ["a b", "\ta\t", "", "", None]


def test_strip_markup_removes_literal_tags(spark):
    strip = lambda c: strip_markup(c, ("<i>", "</i>"))
    assert values(spark, strip, ["<i>Aus bus</i> sp. <i>x</i>", "<I>A</I>", "a<i", None]) == [
        "Aus bus sp. x",
        "<I>A</I>",
        "a<i",
        None,
    ]


def test_first_token(spark):
    assert values(spark, first_token, ["Aus bus", "Aus", " Aus", "", None]) == ["Aus", "Aus", "", "", None]


def test_category_falls_back_to_default_also_for_null(spark):
    rules = {"fungi": ("A", "B"), "other": ("C",)}
    got = values(spark, lambda c: category(c, rules, "rest"), ["A", "B", "C", "D", "", None])
    assert got == ["fungi", "fungi", "other", "rest", "rest", "rest"]


def test_null_and_blank(spark):
    assert values(spark, null_as_blank, ["a", "", None]) == ["a", "", ""]
    assert values(spark, blank_as_null, ["a", "", None]) == ["a", None, None]


def test_lowest_rank_and_mask(spark):
    df = spark.createDataFrame([("", "b", "c"), ("a", "", "c"), ("", "", "")], "`fine` string, `mid-rank` string, `top` string")
    ranks = ["fine", "mid-rank", "top"]
    got = df.select(lowest_rank(ranks), lowest_name(ranks), presence_mask(["top"], ["fine"])).collect()
    assert [tuple(r) for r in got] == [("mid-rank", "b", True), ("fine", "a", False), (None, None, False)]
    assert df.where(presence_mask([], [])).count() == 3
