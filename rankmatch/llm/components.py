"""Connected components of a table of links, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmatch.session import store


def _towards_smallest(links: DataFrame, above: bool) -> DataFrame:
    """Tie each node's neighbours to the smallest of them and itself: the larger ones, or the smaller."""
    if above:
        sides = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = sides.join(least, "a")
    if above:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return met.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for every node that has a smaller one.

    Every round ties neighbours to the smallest node around, first the larger ones and then the
    smaller ones, until the links are stars; chains shorten by half or more in each.  A round is
    written to the shared folder, so a lost executor costs one round.  All sums and minima are
    combined per task, so a node with very many links is no single task's work.
    Links with a null end are left out; an empty table gives an empty result.
    """
    current = store(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links"
    )
    before = None
    while True:
        marks = F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = tuple(current.agg(*marks).first())
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        larger = _towards_smallest(current, True).distinct()
        current = store(_towards_smallest(larger, False).distinct(), "links")
