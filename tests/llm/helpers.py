"""Tables that every text operator must cope with, and plain versions of what several tests need."""

import os
import re

SMALL = "/root/testdata/sf0.001"
HAVE_TABLES = os.path.isdir(SMALL)
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Columns that clash with names the operators use inside.
EXTRA = ("fp", "mark", "size", "shard", "spans", "score", "kept", "root", "__fp", "__text", "rows", "target")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


def docs(spark, rows):
    """A table like ``documents`` from (doc_id, text, lang, source), with clashing columns."""
    full = [(i, t, l, s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, l, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    prose = "the quick brown fox jumps over the lazy dog and runs far away from here every single day of the year "
    return [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, " \n\t ", "en", "a"),
        (4, prose, "en", "b"),
        (4, prose, "en", "b"),
        (None, prose + "again", "en", "b"),
        (None, None, None, None),
        (5, prose * 3000, "de", "b"),
        (6, "x" * 200_000, "de", None),
        (7, "é ü 😀 ñ", "fr", "c"),
        (-8, "one two", "fr", "c"),
    ]


def empty(spark):
    return docs(spark, [])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
