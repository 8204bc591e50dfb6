"""A checklist and an authority table derived from the test tables.

Every line item is a checklist record about its part; its line number says how many ranks
it fills in.  Parts, grouped by each prefix of their ranks, are the nodes of the authority
table.  Both grow with the tables and read all of their rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmatch import settings as S
from rankmatch.functions.names import quoted
from rankmatch.operators.clean import clean_and_store, clean_records
from rankmatch.session import deal, spread
from rankmatch.settings import Correction

# The rules for the derived checklist, the same as in the SQL.
NAME_BLOCK = 2000
KINGDOMS = ("STANDARD", "ECONOMY", "PROMO", "SMALL")
WITH_INFRASPECIFIC = ("PROMO", "ECONOMY")
RENAMES = S.RENAMES
LOG_COLUMNS = ("data cleanup changes 1", "query")
KINGDOM_BY_PHYLUM = {
    "PROMO": ("Brand#1", "Brand#2"),
    "MEDIUM": ("Brand#3",),
    "LARGE": ("Brand#4",),
}
DEFAULT_KINGDOM = "STANDARD"
CORRECTIONS = (
    Correction(
        "infraspecificEpithet", (("genericName", "ring Brand#13"), ("specificEpithet", "7")), "8"
    ),
    Correction("specificEpithet", (("genericName", "ring Brand#13"), ("specificEpithet", "7")), "8"),
    Correction("specificEpithet", (("genericName", "bolt Brand#5"), ("specificEpithet", "11x")), "11"),
    Correction("specificEpithet", (("genericName", "gear Brand#21"), ("specificEpithet", "9")), "10"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _word(n: int) -> Column:
    return F.split_part("p_name", F.lit(" "), F.lit(n))


def _ranks_of_part() -> dict[str, Column]:
    # Names are used anew for every so many parts, so nodes per name do not grow with the tables.
    block = F.floor((F.col("p_partkey") - 1) / NAME_BLOCK)
    suffix = F.when(block > 0, F.concat(F.lit("-"), block.cast("string"))).otherwise("")
    of_brand = [F.lit(" "), F.col("p_brand"), suffix]
    return {
        "kingdom": F.col("p_type"),
        "phylum": F.col("p_brand"),
        "class": F.concat(_word(1), *of_brand),
        "order": F.concat(_word(2), *of_brand),
        "family": F.concat("p_name", *of_brand),
        "genus": F.concat(_word(2), *of_brand),
        "specificEpithet": F.col("p_size").cast("string"),
        "infraspecificEpithet": F.when(
            F.col("p_type").isin(*WITH_INFRASPECIFIC), F.col("p_partkey").cast("string")
        ),
    }


def _packed(tests: Sequence[Column]) -> Column:
    """Answers as one number, three values each: no, yes, unknown."""
    digits = [F.when(t.isNull(), 2).when(t, 1).otherwise(0) * 3**i for i, t in enumerate(tests)]
    return reduce(add, digits)


def _unpacked(name: str, i: int) -> Column:
    """The answer number ``i`` of :func:`_packed`."""
    digit = F.expr(f"`{name}` div {3**i} % 3")
    return F.when(digit < 2, digit == 1)


def raw_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checklist as it would come from a file: padded names, markup, gaps, log columns."""
    tests = {
        "has_phylum": (F.col("l_linenumber") > 1) | (F.col("l_returnflag") != "R"),
        "has_class": F.col("l_discount") != 0,
        "has_genus": F.col("l_tax") != 0.01,
        "is_misspelt": F.col("l_tax") == 0.08,
    }
    kept = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    # Tested before the lines are shuffled to their parts: the answers are narrower than the values.
    tested = table(spark, sf_dir, "lineitem").select(*kept, *[test.alias(name) for name, test in tests.items()])
    lines = spread(tested.select(*kept, _packed([F.col(name) for name in tests]).alias("tests")))
    has = {name: _unpacked("tests", i) for i, name in enumerate(tests)}
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    rank = _ranks_of_part()
    depth = F.col("l_linenumber")
    misspelt = F.when(has["is_misspelt"], "x").otherwise("")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.concat(F.lit("L-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("speciesId"),
        F.concat(F.lit("<i>"), "p_name", F.lit("</i> "), "p_brand").alias("taxonName"),
        F.lit("x").alias("domain "),
        F.when(has["has_phylum"], F.concat(F.lit("  "), rank["phylum"], F.lit(" "))).alias("phylum"),
        F.when((depth >= 2) & has["has_class"], rank["class"]).alias("class"),
        F.when(depth >= 3, rank["order"]).alias("order"),
        F.when(depth >= 4, rank["family"]).alias("family"),
        F.when(depth >= 5, F.when(has["has_genus"], F.concat(F.lit(" "), rank["genus"]))).alias("genus"),
        F.when(depth >= 6, F.concat(rank["specificEpithet"], misspelt)).alias("species"),
        F.when(depth >= 7, rank["infraspecificEpithet"]).alias("subspecies"),
        F.col("l_returnflag").alias("data cleanup changes"),
        F.col("l_linestatus").alias("query"),
        F.col("l_returnflag").alias("Unnamed: 17"),
        F.lit(None).cast("string").alias("tribe"),
    )


_CLEANING = {
    "renames": RENAMES,
    "log_columns": LOG_COLUMNS,
    "corrections": CORRECTIONS,
    "kingdoms": KINGDOM_BY_PHYLUM,
    "default_kingdom": DEFAULT_KINGDOM,
}


def cleaned_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned checklist with its empty columns, for queries that choose columns."""
    return clean_records(raw_checklist(spark, sf_dir), empty_columns=(), **_CLEANING)


def stored_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned checklist as a table; that ``tribe`` is empty is found while it is written."""
    return clean_and_store(raw_checklist(spark, sf_dir), **_CLEANING)


def backbone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authority table: one node per prefix of ranks, absent ranks null."""
    # Every part becomes a row per prefix, so the parts are dealt out by their number before that.
    parts = deal(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")).select(
        "p_partkey", "p_size", *[c.alias(r) for r, c in _ranks_of_part().items()]
    )
    ranks = list(reversed(S.RANKS))
    sets = [[quoted(r) for r in ranks[:n]] for n in range(1, len(ranks) + 1)]
    nodes = (
        parts.groupingSets(sets, *[quoted(r) for r in ranks])
        .agg(
            F.bit_count(F.grouping_id()).cast("long").alias("absent"),
            F.min("p_partkey").alias("first_part"),
            F.min("p_size").alias("low"),
            F.max("p_size").alias("high"),
        )
        .where("absent > 0 OR infraspecificEpithet IS NOT NULL")
    )
    low = F.col("low")
    status = (
        F.when(low <= 30, "accepted")
        .when(low <= 38, "synonym")
        .when(low <= 42, "homotypic synonym")
        .when(low <= 45, "heterotypic synonym")
        .when(low <= 47, "proparte synonym")
        .otherwise("doubtful")
    )
    named = F.coalesce(
        F.when(
            F.col("specificEpithet").isNotNull(), F.concat("genus", F.lit(" "), "specificEpithet")
        ),
        *[quoted(r) for r in S.RANKS[2:]],
    )
    rank_name = F.element_at(F.array(*[F.lit(r) for r in ("species", *S.RANKS[2:])]), F.col("absent").cast("int"))
    return nodes.select(
        (F.col("first_part") * 10 + F.col("absent")).alias(S.NODE_ID),
        F.when((low > 30) & (low <= 47), (F.col("first_part") - 1) * 10 + F.col("absent")).alias(S.ACCEPTED_ID),
        F.when(F.col("high") == 7, "unranked")
        .when(F.col("absent") == 0, "subspecies")
        .otherwise(rank_name)
        .alias(S.NODE_RANK),
        status.alias(S.STATUS),
        F.when(~F.startswith(F.coalesce("phylum", F.lit("")), F.lit("Brand#2")), named).alias(S.CANONICAL),
        F.col("genus").alias("genericName"),
        *[quoted(r) for r in ranks],
    )


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records filled down to the genus, one per supplier, absent ranks as ``''``."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    rank = _ranks_of_part()
    named = [rank[r].alias(r) for r in reversed(S.RANKS[2:])]
    return suppliers.join(parts, suppliers.s_suppkey == parts.p_partkey).select(
        F.col("s_suppkey").alias("record_id"),
        *named,
        F.lit("").alias("specificEpithet"),
        F.lit("").alias("infraspecificEpithet"),
    )
