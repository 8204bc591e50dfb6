"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings the jobs rely on: run-time re-planning sizes partitions, turns joins with a
# small measured side into broadcast joins and splits skewed join partitions.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "rankmatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Session with :data:`RECOMMENDED` and case-sensitive names.

    Checklists may hold headers that differ in case only, so names are case-sensitive.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.caseSensitive", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RECOMMENDED, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str | None:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    None in a local session without the setting.  On a cluster it is required: a folder of
    one machine would be lost with it.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return configured or None


def store(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives the planner the true size
    of the table, so that later joins broadcast it only when it is small enough.  A local
    session without a folder keeps the rows in Spark's own block storage on disk, which goes
    with the session.
    """
    spark = df.sparkSession
    base = base or shared_dir(spark)
    if base is None:
        return df.persist(StorageLevel.DISK_ONLY)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table just read, dealt out to the session's tasks if it is smaller than one split for each core.

    Such a table, above all one of a single row group, would keep all work on it, and every table
    stored from it, in a few tasks.  Dealing it out costs a shuffle of less than a split per core;
    larger tables have splits enough and are not shuffled.  Rows go by their hash, so a task that is
    run again gives the same.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if size >= split * spark.sparkContext.defaultParallelism:
        return df
    names = ["`" + f.name.replace("`", "``") + "`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.repartition(F.xxhash64(*names)) if names else df


# Rows of a dealt table that go to one task.
DEALT_ROWS = 50_000


def deal(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A table just read, dealt out to tasks of about ``rows`` rows each, by default :data:`DEALT_ROWS`.

    For rows that are multiplied before they are aggregated: a compressed table of millions of rows may
    be one split, and that task's memory would grow with the table.  Rows go by their hash, so a task
    that is run again gives the same.  A table of one task's rows is left as it is.
    """
    tasks = -(-df.count() // (rows or DEALT_ROWS))
    names = ["`" + f.name.replace("`", "``") + "`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.repartition(tasks, F.xxhash64(*names)) if names and tasks > 1 else df


def store_observed(
    df: DataFrame, name: str, measures: Mapping[str, Column], base: str | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """:func:`store` and the values of aggregates, taken while the rows are written.

    The rows pass once: nothing is read again for the aggregates.
    """
    seen, names = Observation(), list(measures)
    # Names of measures may be any text, metric names are numbered.
    watched = df.observe(seen, *[measures[m].alias(f"m{i}") for i, m in enumerate(names)]) if names else df
    stored = store(watched, name, base)
    if stored.is_cached:
        stored.count()
    found = seen.get if names else {}
    return stored, {m: found[f"m{i}"] for i, m in enumerate(names)}


def working_folder(spark: SparkSession, name: str) -> str:
    """A new path for files: in the shared folder, or in a local session without one in a folder that goes with it."""
    base = shared_dir(spark)
    if base is None:
        base = tempfile.mkdtemp(prefix="rankmatch-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def case_sensitive(spark: SparkSession) -> Iterator[None]:
    """Names that differ in case only are different in here."""
    key = "spark.sql.caseSensitive"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
