"""Expressions over the rank columns of a record, where an absent rank is ``''``.

They are written as SQL text: a mask over eight columns is then one expression to build
instead of dozens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankmatch.functions.names import literal, quote


def mask_sql(filled: Sequence[str], blank: Sequence[str]) -> str:
    """Condition for records that have all of ``filled`` and none of ``blank``."""
    tests = [f"{quote(c)} <> ''" for c in filled] + [f"{quote(c)} = ''" for c in blank]
    return " AND ".join(tests) if tests else "TRUE"


def presence_mask(filled: Sequence[str], blank: Sequence[str]) -> Column:
    """True for records that have all of ``filled`` and none of ``blank``."""
    return F.expr(mask_sql(filled, blank))


def lowest_rank(ranks: Sequence[str]) -> Column:
    """Name of the finest rank that is not empty; ``ranks`` are given finest first."""
    cases = " ".join(f"WHEN {quote(r)} <> '' THEN {literal(r)}" for r in ranks)
    return F.expr(f"CASE {cases} END")


def lowest_name(ranks: Sequence[str]) -> Column:
    """Value at the finest rank that is not empty."""
    return F.expr("coalesce(" + ", ".join(f"nullif({quote(r)}, '')" for r in ranks) + ")")
