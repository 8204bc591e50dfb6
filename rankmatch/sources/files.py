"""CSV checklist, TSV authority table, CSV results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rankmatch import settings as S
from rankmatch.functions.names import quoted
from rankmatch.operators.clean import cast_ids, map_strings
from rankmatch.session import store

# Stands for a quoted empty string while the file is parsed; an unquoted one is null.
_EMPTY = "\u0001"


def read_records(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    ids: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Checklist CSV with header, all columns as strings.

    An unquoted empty field is null, a quoted one is ``''``.  ``multi_line`` allows line
    breaks inside quotes; such files cannot be split, so it is off by default.
    """
    if schema is None and spark.conf.get("spark.sql.caseSensitive") != "true":
        raise ValueError(
            "set spark.sql.caseSensitive=true: headers that differ in case only get renamed otherwise"
        )
    reader = spark.read.options(
        header=True, quote='"', escape='"', emptyValue=_EMPTY, multiLine=multi_line
    )
    if schema is not None:
        reader = reader.schema(schema)
    df = map_strings(reader.csv(path), lambda c: F.when(c == _EMPTY, "").otherwise(c))
    return cast_ids(df, ids)


def read_backbone(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    ids: Sequence[str] = (S.NODE_ID, S.ACCEPTED_ID),
) -> DataFrame:
    """Authority TSV with header; quotes and backslashes are plain characters."""
    reader = spark.read.options(header=True, sep="\t", quote="", escape="")
    if schema is not None:
        reader = reader.schema(schema)
    return cast_ids(reader.csv(path), ids)


# An id as text: what a cast to long accepts.
_ID = r"^\s*[+-]?[0-9]+\s*$"


def read_backbone_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    ids: Sequence[str] = (S.NODE_ID, S.ACCEPTED_ID),
    header: bool = True,
    base: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, rejects) of an authority TSV: a malformed line costs that line and not the job.

    ``rejects`` has the ``line`` and the ``reason``: another number of columns than the schema
    (``columns``), or an id that is no whole number in range (``id <name>``, the first one).  The
    file is parsed once, into a table that both results read.  Without ``schema`` the columns are
    those of the header.
    """
    reader = spark.read.options(header=header, sep="\t", quote="", escape="")
    if schema is None:
        if not header:
            raise ValueError("a file without header needs a schema")
        schema = reader.csv(path).schema
    raw = "__line"
    wide = StructType([*schema.fields, StructType().add(raw, StringType()).fields[0]])
    rows = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=raw).schema(wide).csv(path)
    wrong = F.when(quoted(raw).isNotNull(), F.lit("columns"))
    for name in ids:
        good = F.when(quoted(name).rlike(_ID), quoted(name).try_cast("long")).isNotNull()
        wrong = wrong.when(quoted(name).isNotNull() & ~good, F.lit(f"id {name}"))
    parsed = store(rows.withColumn("__reason", wrong), "parsed", base)
    line = F.coalesce(quoted(raw), F.concat_ws("\t", *[F.coalesce(quoted(c), F.lit("")) for c in schema.names]))
    nodes = parsed.where("__reason IS NULL").drop(raw, "__reason")
    rejects = parsed.where("__reason IS NOT NULL").select(line.alias("line"), F.col("__reason").alias("reason"))
    return cast_ids(nodes, ids), rejects


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    compression: str = "none",
) -> None:
    """CSV folder with header: null is blank, ``''`` is ``""``, inner quotes are doubled.

    ``partition_by`` columns become folders of their values, all written by one job.
    ``compression`` is a codec of Spark's text files, such as ``"gzip"``.
    """
    nulls = [
        quoted(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "void" else quoted(f.name)
        for f in df.schema.fields
    ]
    df.select(nulls).write.mode(mode).partitionBy(*partition_by).options(
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        compression=compression,
    ).csv(path)


def string_schema(columns: Sequence[str]) -> StructType:
    """Schema of string columns, for files whose header need not be inferred."""
    schema = StructType()
    for name in columns:
        schema = schema.add(name, StringType())
    return schema
