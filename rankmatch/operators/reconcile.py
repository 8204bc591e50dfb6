"""Putting the stages together, counting them, looking at them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import quote, quoted
from rankmatch.operators.clean import cast_ids
from rankmatch.operators.joins import Join, drop_keys, lookup


def append(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def reconcile(
    unmatched: DataFrame,
    first: DataFrame,
    second: DataFrame,
    record_id: str = S.RECORD_ID,
    parent_id: str = S.PARENT_ID,
    join: Join = lookup,
) -> tuple[DataFrame, DataFrame]:
    """(all matches, remainder): the second stage followed by the first, and what is in neither."""
    matches = append(second, cast_ids(first, [parent_id]))
    return matches, drop_keys(unmatched, matches, [record_id], join)


def match_summary(record_id: str = S.RECORD_ID, **stages: DataFrame) -> DataFrame:
    """Rows and distinct records per stage, also of stages without rows.

    All stages are tagged and counted together: ids are shuffled once.  Rows are counted per
    stage and id first, so that counting distinct ids stays distributed.
    """
    tagged = []
    for name, df in stages.items():
        tag = F.lit(name).alias("stage")
        ids = df.select(tag, quoted(record_id).alias("id"), F.lit(1).alias("n"))
        # A row that counts nothing keeps the stage where it has no rows.
        none = df.sparkSession.range(1).select(tag, F.lit(None).cast(df.schema[record_id].dataType).alias("id"), F.lit(0).alias("n"))
        tagged += [ids, none]
    per_record = append(*tagged).groupBy("stage", "id").agg(F.sum("n").alias("n"))
    return per_record.groupBy("stage").agg(F.sum("n").alias("n_rows"), F.count("id").alias("n_records"))


def inspect(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Chosen columns of the rows that satisfy ``where``, sorted by ``order_by``."""
    if where is not None:
        df = df.where(where)
    if order_by:
        df = df.orderBy(*map(quote, order_by))
    return df if columns is None else df.select(*map(quote, columns))
