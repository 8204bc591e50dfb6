"""Quality rules: plain counts, and robust multivariate outliers by language and source.

Every text is reduced to a vector of transformed statistics.  For each language and source the
minimum-covariance-determinant estimate finds the mean and covariance of the tightest
three quarters of the vectors; a document whose Mahalanobis distance from them is too large is
rejected, as is one that breaks a plain rule.

The estimate takes concentration steps over all rows: each is one aggregate that finds, per
group, the distance below which three quarters of the rows lie, and one that sums the vectors
below it.  Both are combined per task, so a group with a third of all rows is no single task's
work.  A group takes steps until its determinant settles.  Two starts are carried at once, the medians with the median deviations, and the means
with the covariance of all rows; the one of smaller determinant stays.

Groups of fewer than ``least`` rows are pooled by language, and what is still too small over all
languages; a pool that remains too small rejects nothing.

Defined results: a null or empty text has no words and fails the base rule; null languages and
sources are groups like any other; a null or repeated id and equal rows are each judged alone; a
statistic, or mix of them, that is the same in nearly all rows has a floor under its spread, so it
cannot make a covariance singular, and any larger spread stays as estimated; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import by_texts, column, free_name
from rankmatch.operators.joins import attach_stored
from rankmatch.session import store

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BROADCAST_GROUPS = 50_000


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five counts of :data:`COUNTS` of one whole UTF-8 text."""
    words = text.split()
    chars = len(text.decode()) - sum(map(text.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        upto = 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def statistics(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, lang, source and the counts of every row."""
    rows = docs.select(
        column(id_col).alias("doc_id"),
        column(lang_col).cast("string").alias("lang"),
        column(source_col).cast("string").alias("source"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = np.array([counts(t) for t in pc.cast(batch.column(3), pa.large_binary()).to_pylist()], np.int64)
            found = found.reshape(-1, len(COUNTS))
            columns = [*batch.columns[:3], *(pa.array(found[:, i]) for i in range(len(COUNTS)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "source", *COUNTS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return by_texts(rows, run, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS))


@dataclass(frozen=True)
class Settings:
    """``inner``: share of a group's rows its estimate is fitted to.  ``floor``: least spread of each vector
    element, which stands in for smaller ones only.  ``distance``: squared Mahalanobis distance, scaled so that
    its median is that of a chi-square with as many degrees of freedom as spreads above the floor, above which
    a document is rejected; the default is the 0.9999 quantile for five.  ``settled``: decrease of the
    logarithm of a determinant up to which it has settled.
    """

    inner: float = 0.75
    floor: tuple[float, ...] = (0.05, 0.02, 0.05, 0.05, 0.05)
    distance: float = 25.74
    least: int = 50
    settled: float = 1e-3


# Medians of the chi-square distributions with one to five degrees of freedom.
_MIDDLES = (0.454936423, 1.386294361, 2.365973884, 3.356693980, 4.351460191)
_SIZE = len(COUNTS)


def vector() -> list[Column]:
    """The transformed statistics: length of the text and its words, and shares of what should be rare."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.sqrt(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


def _x(i: int) -> Column:
    return F.col(f"x{i}")


def _distance() -> Column:
    """Squared distance from the columns m (mean) and p (inverse covariance, row by row)."""
    off = [_x(i) - F.element_at("m", i + 1) for i in range(_SIZE)]
    terms = [F.element_at("p", i * _SIZE + j + 1) * off[i] * off[j] for i in range(_SIZE) for j in range(_SIZE)]
    return sum(terms[1:], terms[0])


_MOMENTS = [(i, j) for i in range(_SIZE) for j in range(i, _SIZE)]


def _moments() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.array(*[F.sum(_x(i)) for i in range(_SIZE)]).alias("s"),
        F.array(*[F.sum(_x(i) * _x(j)) for i, j in _MOMENTS]).alias("q"),
    ]


def _shape(
    n: float, sums: np.ndarray, squares: np.ndarray, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, covariance, and how many of its spreads are above the floor."""
    mean = sums / n
    cov = np.zeros((_SIZE, _SIZE))
    for (i, j), value in zip(_MOMENTS, squares):
        cov[i, j] = cov[j, i] = value / n - mean[i] * mean[j]
    # In units of the floor, each spread along an axis of the ellipsoid is one or more.
    spreads, axes = np.linalg.eigh(cov / np.outer(floor, floor))
    raised = (axes * np.maximum(spreads, 1)) @ axes.T
    return mean, (cov if spreads[0] >= 1 else raised * np.outer(floor, floor)), int((spreads > 1).sum())


def _params(settings: Settings):
    """Mean, inverse and log-determinant of each group from its moments, in Arrow batches."""
    floor = np.array(settings.floor)

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                mean, cov, free = _shape(r["n"], np.array(r["s"]), np.array(r["q"]), floor)
                rows.append(
                    {"cell": r["cell"], "start": r["start"], "m": mean.tolist(),
                     "p": np.linalg.inv(cov).ravel().tolist(), "det": float(np.linalg.slogdet(cov)[1]), "free": free}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_PARAMS)

    return run


_LIST = pa.list_(pa.float64())
_PARAMS = pa.schema(
    [("cell", pa.string()), ("start", pa.int32()), ("m", _LIST), ("p", _LIST), ("det", pa.float64()),
     ("free", pa.int32())]
)
_PARAMS_DDL = "cell string, start int, m array<double>, p array<double>, det double, free int"


def cells(rows: DataFrame, least: int) -> DataFrame:
    """Which ``cell`` each (lang, source) belongs to: itself, the pool of its language, or the pool of all."""
    named = F.concat_ws(":", F.lit("g"), F.to_json(F.struct("lang", "source")))
    language = F.concat_ws(":", F.lit("l"), F.to_json(F.struct("lang")))
    sizes = store(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "sizes")
    pools = sizes.where(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("pool"))
    pools = pools.withColumnRenamed("lang", "pool_lang")
    joined = sizes.join(pools, F.col("lang").eqNullSafe(F.col("pool_lang")), "left")
    cell = F.when(F.col("n") >= least, named).when(F.col("pool") >= least, language).otherwise(F.lit("all"))
    return joined.select(F.col("lang").alias("cell_lang"), F.col("source").alias("cell_source"), cell.alias("cell"), "n")


def beside(points: DataFrame, groups: DataFrame, few: bool, kind: str = "inner") -> DataFrame:
    """``points`` with what ``groups`` says of their ``cell``.

    Few groups are broadcast; of many, the points of a cell with very many rows are spread over several tasks.
    """
    if few:
        return points.join(F.broadcast(groups), "cell", kind)
    return attach_stored(points, store(groups, "beside"), ["cell"], kind, points.select("cell"), limit=0)


def estimates(points: DataFrame, settings: Settings, few: bool) -> DataFrame:
    """``n``, mean ``m``, inverse covariance ``p`` and distance scale ``scale`` of each ``cell`` of points x0, x1, ...

    ``few`` tells that the table of cells is small enough to broadcast.
    """
    near = F.broadcast if few else (lambda groups: groups)

    def middle(value: Column, share: float = 0.5) -> Column:
        return F.percentile_approx(value, F.lit(share), F.lit(1000))

    ranks = [middle(_x(i)).alias(f"c{i}") for i in range(_SIZE)]
    centres = store(points.groupBy("cell").agg(F.count("*").alias("n"), *ranks), "centres")
    away = beside(points, centres, few)
    spread = away.groupBy("cell").agg(*[middle(F.abs(_x(i) - F.col(f"c{i}"))).alias(f"d{i}") for i in range(_SIZE)])
    # 1.4826 median deviations are a standard deviation of normal numbers.
    least = [F.lit(x) for x in settings.floor]
    variance = [F.pow(F.greatest(F.col(f"d{i}") * 1.4826, least[i]), F.lit(2)) for i in range(_SIZE)]
    inverse = [1 / variance[i] if i == j else F.lit(0.0) for i in range(_SIZE) for j in range(_SIZE)]
    medians = centres.join(near(spread), "cell").select(
        "cell",
        F.lit(0).alias("start"),
        F.array(*[F.col(f"c{i}") for i in range(_SIZE)]).alias("m"),
        F.array(*inverse).alias("p"),
        F.lit(None).cast("double").alias("det"),
        F.lit(0).alias("free"),
    )
    whole = points.groupBy("cell").agg(*_moments()).withColumn("start", F.lit(1))
    now = store(medians.union(whole.mapInArrow(_params(settings), _PARAMS_DDL)), "estimates")
    now = now.withColumn("det", F.lit(None).cast("double"))
    done: list[DataFrame] = []
    while True:
        placed = beside(points, now, few)
        limits = placed.groupBy("cell", "start").agg(middle(_distance(), settings.inner).alias("limit"))
        limits = store(now.join(near(limits), ["cell", "start"]), "limits")
        inside = beside(points, limits, few).where(_distance() <= F.col("limit"))
        fitted = inside.groupBy("cell", "start").agg(*_moments()).mapInArrow(_params(settings), _PARAMS_DDL)
        before = now.select("cell", "start", F.col("det").alias("before"))
        moves = F.coalesce(F.col("det") < F.col("before") - settings.settled, F.lit(True))
        # Of each group and start only the settled estimate is kept.
        now = store(fitted.join(near(before), ["cell", "start"]).withColumn("moves", moves).drop("before"), "estimates")
        done.append(now.where(~F.col("moves")).drop("moves"))
        now = now.where("moves").drop("moves")
        if now.isEmpty():
            break
    best = reduce(DataFrame.union, done).groupBy("cell").agg(F.min(F.struct("det", "start", "m", "p", "free")).alias("b"))
    best = best.select("cell", "b.m", "b.p", "b.free")
    best = store(best, "best")
    middles = beside(points, best, few).groupBy("cell").agg(middle(_distance()).alias("middle"))
    # The distances of most rows vary along the axes with a spread only; without any there is nothing to scale.
    usual = F.get(F.array(*map(F.lit, _MIDDLES)), F.col("free") - 1)
    scale = F.when((F.col("free") > 0) & (F.col("middle") > 0), F.col("middle") / usual).otherwise(1.0)
    return best.join(near(middles), "cell").join(near(centres.select("cell", "n")), "cell").select(
        "cell", "n", "m", "p", scale.alias("scale")
    )


def judge(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, the counts, ``base_failed``, ``kept`` and the scaled squared ``distance`` of every row."""
    rows = store(statistics(docs, id_col, text_col, lang_col, source_col), "statistics")
    groups = store(cells(rows, settings.least), "cells")
    few = groups.count() <= BROADCAST_GROUPS
    xs = [x.alias(f"x{i}") for i, x in enumerate(vector())]
    if few:
        own = F.col("lang").eqNullSafe(F.col("cell_lang")) & F.col("source").eqNullSafe(F.col("cell_source"))
        placed = rows.join(F.broadcast(groups), own)
    else:
        # Missing values are left out of the text, so it tells any two groups apart.
        left = rows.withColumn("group", F.to_json(F.struct("lang", "source")))
        table = groups.select(F.to_json(F.struct(F.col("cell_lang").alias("lang"), F.col("cell_source").alias("source"))).alias("group"), "cell", "n")
        placed = attach_stored(left, store(table, "groups"), ["group"], "left", left.select("group"), limit=0)
    points = store(placed.select("doc_id", "cell", *COUNTS, *xs), "points")
    found = store(estimates(points.select("cell", *[f"x{i}" for i in range(_SIZE)]), settings, few), "found")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    usual = (F.col("n") < settings.least) | (F.col("distance") <= settings.distance)
    judged = beside(points, found, few).withColumn("distance", _distance() / F.col("scale"))
    return judged.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & usual).alias("kept"), "distance")


def keep(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of ``docs`` that the rules keep; a row without an id goes with the verdict on any such row."""
    verdict = judge(docs, settings, id_col, **columns).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    name = free_name(docs.columns, "__good")
    good = verdict.where("kept").select(F.col("doc_id").alias(name))
    return docs.join(good, column(id_col).eqNullSafe(column(name)), "left_semi")
