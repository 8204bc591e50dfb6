"""Expressions over single name columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Name in backticks: checklist headers hold blanks, dots and slashes."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name."""
    return F.col(quote(name))


def literal(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trim_blanks(col: Column) -> Column:
    """Cut blanks, and only blanks, at both ends; tabs stay."""
    return F.trim(col)


def strip_markup(col: Column, tags: Sequence[str]) -> Column:
    """Remove every occurrence of the literal ``tags``."""
    return reduce(lambda c, tag: F.replace(c, F.lit(tag), F.lit("")), tags, col)


def first_token(col: Column) -> Column:
    """Text before the first blank."""
    return F.split_part(col, F.lit(" "), F.lit(1))


def null_as_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def blank_as_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def category(col: Column, rules: Mapping[str, Sequence[str]], default: str) -> Column:
    """Name of the rule whose values hold ``col``; ``default`` when none does or it is null."""
    hits = [F.when(col.isin(*values), F.lit(name)) for name, values in rules.items()]
    return F.coalesce(*hits, F.lit(default))
