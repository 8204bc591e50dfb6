"""Cleaning of a raw checklist: names, blanks, corrections, categories."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rankmatch import settings as S
from rankmatch.functions.names import (
    blank_as_null,
    category,
    first_token,
    null_as_blank,
    quoted,
    strip_markup,
    trim_blanks,
)
from rankmatch.operators.joins import Join, lookup
from rankmatch.session import store_observed
from rankmatch.settings import Correction


# Everything a cast to long accepts.
_INTEGER = r"^[\s\x00-\x20\x7f]*[+-]?[0-9]+[\s\x00-\x20\x7f]*$"


def require(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a column is missing: Spark's own rename and drop ignore that."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def rename_strict(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    require(df, list(names))
    return df.withColumnsRenamed(dict(names))


def drop_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require(df, columns)
    return df.drop(*columns)


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Drop the columns whose name starts with ``prefix``."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def map_strings(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every string column, in one projection."""
    return df.select(
        [
            fn(quoted(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def trim_strings(df: DataFrame) -> DataFrame:
    return map_strings(df, trim_blanks)


def fill_blank(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null to ``''`` in the given string columns, or in all of them."""
    if columns is None:
        return map_strings(df, null_as_blank)
    return df.withColumns({c: null_as_blank(quoted(c)) for c in columns})


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_as_null(quoted(c)) for c in columns})


def cast_ids(df: DataFrame, columns: Sequence[str], malformed: str = "error") -> DataFrame:
    """Ids to long; a malformed id raises, or becomes null with ``malformed="null"``."""
    if malformed not in ("error", "null"):
        raise ValueError(f"malformed must be 'error' or 'null', not {malformed!r}")
    if malformed == "null":
        # A failing try_cast is slow; the pattern keeps it to text that looks like a number.
        return df.withColumns(
            {
                c: F.when(quoted(c).cast("string").rlike(_INTEGER), quoted(c).try_cast("long"))
                for c in columns
            }
        )
    return df.withColumns({c: quoted(c).cast("long") for c in columns})


def null_profile(df: DataFrame, feature: str = "feature", count: str = "len") -> DataFrame:
    """One row per column: its name and how many nulls it holds.  One pass over the data."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [quoted(c) for c in df.columns], feature, count)


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns without a single value.  Brings one row of counts to the driver."""
    if not df.columns:
        return []
    found = df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns]).first()
    return [c for c, n in zip(df.columns, found) if n == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def apply_corrections(df: DataFrame, rules: Sequence[Correction]) -> DataFrame:
    """Apply rules to the uncorrected values, all in one projection; the first hit wins.

    Meant for rule lists written down in code.  For a rule table of any size use
    :func:`correct_from_table`.
    """
    hits: dict[str, list[Column]] = {}
    for rule in rules:
        same = reduce(and_, [quoted(c) == value for c, value in rule.when])
        hits.setdefault(rule.column, []).append(F.when(same, F.lit(rule.value)))
    return df.withColumns({c: F.coalesce(*cases, quoted(c)) for c, cases in hits.items()})


def correct_from_table(
    df: DataFrame,
    rules: DataFrame,
    on: Sequence[str],
    column: str,
    value: str = "corrected",
    join: Join = lookup,
) -> DataFrame:
    """Overwrite ``column`` by ``rules[value]`` where the ``on`` columns agree.

    One correction per key is used, the smallest one.
    """
    best = rules.groupBy(*on).agg(F.min(quoted(value)).alias("__corrected"))
    joined = join(df, best, on, "left")
    return joined.withColumn(column, F.coalesce("__corrected", quoted(column))).select(
        [quoted(c) for c in df.columns]
    )


def derive_genus(
    df: DataFrame, genus: str = "genus", epithet: str = "specificEpithet", name: str = "taxonName"
) -> DataFrame:
    """First word of ``name`` as the genus of records that have an epithet but no genus."""
    missing = quoted(genus).isNull() & quoted(epithet).isNotNull()
    return df.withColumn(genus, F.when(missing, first_token(quoted(name))).otherwise(quoted(genus)))


def clean_records(
    df: DataFrame,
    renames: Mapping[str, str] = S.RENAMES,
    log_columns: Sequence[str] = S.LOG_COLUMNS,
    log_prefix: str = S.LOG_PREFIX,
    corrections: Sequence[Correction] | None = None,
    kingdoms: Mapping[str, Sequence[str]] = S.KINGDOM_BY_PHYLUM,
    default_kingdom: str = S.DEFAULT_KINGDOM,
    domain: str = S.DOMAIN,
    markup: Sequence[str] = S.MARKUP,
    empty_columns: Sequence[str] | None = None,
    keep: Sequence[str] = ("taxonName", "genericName", *S.RANKS),
) -> DataFrame:
    """Raw checklist to cleaned checklist.

    Columns without a value are dropped, except those to ``keep`` because later steps read
    them; ``empty_columns`` names them when they are known, which saves the pass over the
    data.  A column of blanks is not empty.  Log columns go first, so they are not counted.
    """
    rules = S.default_corrections() if corrections is None else corrections
    df = trim_strings(rename_strict(df, renames)).withColumn("genericName", quoted("genus"))
    df = drop_prefix(drop_strict(df, log_columns), log_prefix)
    empty = all_null_columns(df.drop(*keep)) if empty_columns is None else empty_columns
    df = df.drop(*[c for c in empty if c not in keep])
    df = apply_corrections(fill_blank(df, ["infraspecificEpithet"]), rules)
    return df.withColumns(
        {
            "domain": F.lit(domain),
            "kingdom": category(quoted("phylum"), kingdoms, default_kingdom),
            "taxonName": strip_markup(quoted("taxonName"), markup),
        }
    )


def clean_and_store(
    df: DataFrame,
    keep: Sequence[str] = ("taxonName", "genericName", *S.RANKS),
    base: str | None = None,
    **options: object,
) -> DataFrame:
    """:func:`clean_records` as a stored table, with the raw checklist read once.

    The values of every column are counted while the table is written, and the columns without a
    value are left out when it is read back.
    """
    full = clean_records(df, empty_columns=(), keep=keep, **options)
    counted = {c: F.count(quoted(c)) for c in full.columns if c not in keep}
    stored, values = store_observed(full, "cleaned", counted, base)
    return stored.drop(*[c for c, n in values.items() if n == 0])


# Text that is a whole number, and text that is a number with a fraction or an exponent.
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def infer_types(df: DataFrame) -> DataFrame:
    """One row per column of strings: ``feature``, ``n_values``, ``n_long``, ``n_double`` and its ``type``.

    A column is long if all its values are whole numbers in range, else double if all are numbers,
    else string; a column without a value is a string.  All rows are looked at, in one aggregate:
    a prefix could miss the one value that is no number.
    """
    struct = []
    for name in df.columns:
        value = quoted(name).cast("string")
        # A failing try_cast is slow; the pattern keeps it to text that looks like a number.
        whole = F.when(value.rlike(_WHOLE), value.try_cast("long")).isNotNull()
        number = value.rlike(_NUMBER)
        struct.append(
            F.struct(
                F.count(value).alias("n_values"), F.count_if(whole).alias("n_long"), F.count_if(number).alias("n_double")
            ).alias(name)
        )
    one = df.agg(*struct)
    long = one.unpivot([], [quoted(c) for c in df.columns], "feature", "counts").select("feature", "counts.*")
    some = F.col("n_values") > 0
    kind = F.when(some & (F.col("n_long") == F.col("n_values")), "long").when(
        some & (F.col("n_double") == F.col("n_values")), "double"
    )
    return long.withColumn("type", kind.otherwise("string"))


def with_inferred_types(df: DataFrame) -> DataFrame:
    """``df`` with the types of :func:`infer_types`; one row per column comes to the driver."""
    kinds = {r["feature"]: r["type"] for r in infer_types(df).collect()}
    return df.select([quoted(c).cast(kinds[c]).alias(c) if kinds[c] != "string" else quoted(c) for c in df.columns])
