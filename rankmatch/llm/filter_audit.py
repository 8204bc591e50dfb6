"""How document filters interact: what each removes in every order of applying them.

Whether a document fails a filter depends on the document (and, for copies, on the table) and not
on the filters before it.  So its failures are a row of 0 where it fails and infinity elsewhere, an
order of the filters is a row of positions (the inverse permutation), and the step at which the
order removes the document is the smallest sum of the two: the min-plus product of the mask matrix
with the position matrix.  Documents of one mask share that step, so they are counted per part and
mask first, at most 2^filters rows a part, and the counts are scattered to (order, step).

Defined results: a null or empty text has no word and no character, so it fails the filter of short
texts and no rate; all null and empty texts are copies of one another.  A row without id is no copy,
and rows of one id and text are no copies of each other.  A document is good, or toxic, if any label
row of its id says so; one without id is neither.  A null part is ''.  Texts of any length are read
whole, one at a time.  An empty table gives an empty result.  Columns other than those named are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import column
from rankmatch.operators.joins import attach
from rankmatch.session import store

# Step of a document that no filter of an order removes.
NEVER = np.int64(1) << 32
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> dict[str, Column]:
    """The conditions on a text alone, by letter: few words, few distinct words, capitals, symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    base: str | None = None,
) -> DataFrame:
    """Documents per ``part`` and ``mask``, a bit per failed filter: ``n``, ``good`` and ``toxic``.

    Bit 4, the copies, needs the smallest id of every text: the slim rows (id, digest, mask) look
    themselves up among the pairs of a text and its smallest id.  These keys hardly repeat, however
    many copies a text has.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    own = failures(text)
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(own.values())), F.lit(0))
    slim = store(
        docs.select(
            column(id_col).alias("id"),
            F.coalesce(column(part_col).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            bits.cast("int").alias("own"),
        ),
        "filter-masks",
        base,
    )
    first = slim.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"))
    known = (
        labels.where(column(id_col).isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
        .groupBy(column(id_col).alias("id"))
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
        )
    )
    marked = attach(slim, first.withColumn("is_first", F.lit(True)), ["digest", "id"], base=base)
    marked = attach(marked, known, ["id"], base=base)
    copy = F.when(F.col("id").isNotNull() & F.col("is_first").isNull(), 16).otherwise(0)
    return marked.groupBy("part", (F.col("own") + copy).alias("mask")).agg(
        F.count("*").alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic")
    )


def orders(filters: str) -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and the place of each filter in each order, counted from 1."""
    names = ["".join(p) for p in permutations(filters)]
    return names, np.array([[name.index(f) + 1 for f in filters] for name in names], np.int64)


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: the step at which each order removes each mask, :data:`NEVER` or more if none does.

    ``fails`` is masks x filters, true where the mask fails; ``places`` is orders x filters.
    """
    mask = np.where(fails, np.int64(0), NEVER)
    return (mask[:, None, :] + places[None, :, :]).min(axis=2)


def interactions(fails: np.ndarray, weights: np.ndarray, filters: str) -> pd.DataFrame:
    """One row per order and step.  ``weights`` is masks x 3: all, good and toxic documents."""
    names, places = orders(filters)
    n, steps = len(filters), removal_steps(fails, places)
    # Scatter every mask's weights to the step that removes it; the last slot is for none.
    slot = np.minimum(steps, n + 1) - 1 + (n + 1) * np.arange(len(names))
    lost = np.zeros(((n + 1) * len(names), 3), np.int64)
    np.add.at(lost, slot, np.broadcast_to(weights[:, None, :], (*slot.shape, 3)))
    lost = lost.reshape(len(names), n + 1, 3)[:, :n]
    removed = lost[:, :, 0]
    # The filter applied at each step of each order.
    at = np.argsort(places, axis=1)
    failed = weights[:, 0] @ fails.astype(np.int64)
    alone = weights[:, 0] @ (fails & (fails.sum(axis=1) == 1)[:, None]).astype(np.int64)
    shares = np.zeros(n, np.int64)
    np.add.at(shares, at, removed)
    return pd.DataFrame(
        {
            "filter_order": np.repeat(names, n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(names)),
            "kept": (weights[:, 0].sum() - removed.cumsum(axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": (failed[at] - removed).ravel(),
            "unique_fails": alone[at].ravel(),
            "good_lost": lost[:, :, 1].ravel(),
            "toxic_lost": lost[:, :, 2].ravel(),
            "shapley": shares[at].ravel(),
        }
    )


def audit(counted: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Every part, order and step with its counts, from the rows of :func:`masks`.

    A part has at most one row per mask, so its group is small however many documents it has.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fails = (rows["mask"].to_numpy()[:, None] >> np.arange(len(filters)) & 1).astype(bool)
        found = interactions(fails, rows[["n", "good", "toxic"]].to_numpy(np.int64), filters)
        found.insert(0, "part", rows["part"].iloc[0])
        return found

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return counted.groupBy("part").applyInPandas(run, f"part string, filter_order string, step int, {counts}")

