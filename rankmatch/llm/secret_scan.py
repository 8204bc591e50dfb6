"""Secret scans: fixed patterns, and character Markov models that add to them.

Two models give the chance of each character after the one before, one of random strings and
one of ordinary identifiers.  A long run of identifier characters whose log-likelihood ratio is
high is a secret, whatever stands around it.  The models are trained on labelled samples: random
strings are what the patterns find in a bounded sample of documents, and strings drawn from a
seeded hash in the usual notations; ordinary identifiers are the other runs of these documents,
alone and put together in the usual ways, numbers, and rules of one repeated character.

Everything is DataFrame functions; no Python runs on the executors.

Spans are (kind, start, end) in code points, end exclusive.  Spans of the models are added where
they touch none of a pattern; spans of the patterns always stay.

Defined results: a null or empty text has no spans; rows with a null or repeated id, and equal
rows, are each looked at alone; very long texts are looked at whole, one at a time; an empty table gives an empty result, its models trained on the
drawn strings alone.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import plain
from rankmatch.session import store

KINDS = ("assign", "access", "hex", "markov")
# The patterns, with the group whose length counts and its least length.
PATTERNS = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_K = len(ALPHABET) + 1
_RUN = r"[A-Za-z0-9+/_=-]"


@dataclass(frozen=True)
class Settings:
    """A run of at least ``shortest`` characters is a secret if its log-likelihood ratio, in nats, is
    ``total`` or more, and ``mean`` or more per character.  Random characters give about four nats each,
    so the likelihood decides from 12 characters on; shorter runs are too near to ordinary names.  ``sample_docs`` bounds the documents the
    models are trained on, chosen by a seeded hash; ``drawn`` is the number of drawn strings.
    """

    shortest: int = 12
    total: float = 20.0
    mean: float = 1.5
    sample_docs: int = 2000
    drawn: int = 6000
    seed: int = 31


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_earlier(step: int) -> Callable[[Column], Column]:
    """To every element of an array, add those up to seven steps before it."""

    def all_of(a: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = [F.coalesce(F.get(a, (i - j * step).cast("int")), F.lit(0)) for j in range(1, 8) if j * step < 2**31]
            return x + sum(before[1:], before[0])

        return F.when(F.size(a) > step, F.transform(a, one)).otherwise(a)

    return all_of


def prefix_sums(values: Column) -> Column:
    """Running sums of an array, in rounds of seven steps: as many as its size asks for, at most 11.

    Sizes are below 2 ** 31, and 11 rounds reach 8 ** 11 elements.
    """
    for k in range(11):
        values = let(values, _with_earlier(8**k))
    return values


def matched(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans, as (start, kind number, end, text), of the leftmost non-overlapping matches whose group is long enough."""

    def placed(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda g: F.length(g))
        ends = prefix_sums(F.zip_with(gaps, found, lambda g, m: g + F.length(m)))
        sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda v: F.length(v))
        spans = F.transform(
            F.arrays_zip(ends.alias("e"), found.alias("m"), sizes.alias("n")),
            lambda z: F.struct(
                (z["e"] - F.length(z["m"])).cast("long").alias("start"),
                F.lit(kind).alias("kind"),
                z["e"].cast("long").alias("end"),
                z["m"].alias("match"),
                z["n"].alias("size"),
            ),
        )
        return F.filter(spans, lambda s: s["size"] >= least)

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(
        F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string,size:int>>")
    )


def _codes(token: Column) -> Column:
    """Numbers of a token's characters, from 1; 0 for one that is not in the alphabet."""
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _pairs(tokens: DataFrame, label: int) -> DataFrame:
    """How often each character follows each other one; 0 stands for what is before a token."""
    codes = tokens.select(_codes(F.col("token")).alias("codes"))
    pair = F.transform("codes", lambda c, i: F.when(i > 0, F.get("codes", i - 1)).otherwise(0) * _K + c)
    counted = codes.select(F.explode(pair).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counted.withColumn("label", F.lit(label))


def labelled(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Random strings and ordinary identifiers to train on, each as ``token``."""
    texts = plain(docs).where("doc_id IS NOT NULL")
    share = min(1.0, settings.sample_docs / max(texts.count(), 1))
    mark = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(1_000_000))
    some = texts.where(mark < int(share * 1_000_000)).orderBy(mark, "doc_id").limit(2 * settings.sample_docs)
    some = store(some.select("text"), "sample")

    found = [
        some.select(F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(g))).alias("token")).where(
            F.length("token") >= least
        )
        for p, g, least in PATTERNS.values()
    ]
    drawn = docs.sparkSession.range(settings.drawn).select(
        F.sha2(F.concat_ws(":", F.lit(settings.seed), "id"), 256).alias("hex")
    )
    coded = F.base64(F.unhex("hex"))
    notations = [
        F.col("hex"),
        coded,
        F.translate(coded, "+/=", "-_"),
        F.translate(coded, "+/=", "xY"),
        F.upper(F.translate(coded, "+/=", "7Q")),
        F.lower(F.translate(coded, "+/=", "4k")),
    ]
    random = drawn.select(F.explode(F.array(*notations)).alias("token"))
    for tokens in found:
        random = random.union(tokens)

    runs = F.regexp_extract_all("text", F.lit(_RUN + "{2,}"), F.lit(0))
    plain_runs = F.filter(runs, lambda t: ~t.rlike(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}|[A-Za-z0-9]{32}"))
    single = some.select(plain_runs.alias("runs"))
    following = F.transform("runs", lambda t, i: F.coalesce(F.get("runs", i + 1), F.lit("value")))
    pair = F.arrays_zip(F.col("runs").alias("a"), following.alias("b"))
    joined = [
        lambda z: F.concat_ws("_", F.lower(z["a"]), F.lower(z["b"])),
        lambda z: F.concat_ws("-", F.lower(z["a"]), F.lower(z["b"])),
        lambda z: F.concat(F.lower(z["a"]), F.initcap(z["b"])),
        lambda z: F.concat_ws("_", F.upper(z["a"]), F.upper(z["b"])),
        lambda z: F.concat_ws("/", z["a"], z["b"]),
    ]
    ordinary = single.select(F.explode("runs").alias("token"))
    for how in joined:
        ordinary = ordinary.union(single.select(F.explode(F.transform(pair, how))))
    numbers = docs.sparkSession.range(settings.drawn).select(
        F.explode(
            F.array(
                F.pmod(F.xxhash64(F.lit(settings.seed), "id"), F.lit(10**17)).cast("string"),
                F.date_format(F.timestamp_seconds(F.col("id") * 86_399), "yyyy-MM-dd"),
                F.concat(F.lit("item_"), F.col("id").cast("string")),
            )
        ).alias("token")
    )
    rules = docs.sparkSession.range(1).select(
        F.explode(F.transform(F.split(F.lit(ALPHABET), ""), lambda c: F.repeat(c, F.lit(20_000)))).alias("token")
    )
    return random, ordinary.union(numbers).union(rules)


def train(docs: DataFrame, settings: Settings = Settings()) -> str:
    """The log-likelihood ratios of all pairs of characters, comma-joined: a few thousand numbers.

    Only this one row of a bounded table reaches the driver; it goes to the tasks as a constant.
    """
    random, ordinary = labelled(docs, settings)
    counts = _pairs(random, 1).union(_pairs(ordinary, 0))
    grid = docs.sparkSession.range(_K * _K).select(F.col("id").cast("int").alias("pair"))
    per_pair = counts.groupBy("pair").agg(
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("r"),
        F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("o"),
    )
    filled = grid.join(F.broadcast(per_pair), "pair", "left").select(
        "pair",
        F.floor(F.col("pair") / _K).alias("first"),
        (F.coalesce("r", F.lit(0)) + 0.5).alias("r"),
        (F.coalesce("o", F.lit(0)) + 0.5).alias("o"),
    )
    sums = filled.groupBy("first").agg(F.sum("r").alias("rs"), F.sum("o").alias("os"))
    ratio = F.log(F.col("r") / F.col("rs")) - F.log(F.col("o") / F.col("os"))
    table = filled.join(F.broadcast(sums), "first").agg(
        F.array_sort(F.collect_list(F.struct("pair", F.round(ratio, 6).alias("x")))).alias("t")
    )
    return table.select(F.array_join(F.transform("t", lambda p: p["x"].cast("string")), ",")).first()[0]


def ratio(token: Column, model: str) -> Column:
    """Log-likelihood ratio of a token: above 0 it is more like a random string than like an identifier."""
    table = F.split(F.lit(model), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def read(state: Column, c: Column) -> Column:
        # The start stands for a character before the token and for one outside the alphabet.
        return F.struct(c.alias("before"), (state["sum"] + F.get(table, state["before"] * _K + c)).alias("sum"))

    return F.aggregate(_codes(token), start, read, lambda state: state["sum"])


def scan(
    docs: DataFrame, model: str, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, kind, end) in order, for every row of ``docs``."""
    texts = plain(docs, id_col, text_col)
    text = F.col("text")
    sides = [matched(text, p, g, least, i).alias(k) for i, (k, (p, g, least)) in enumerate(PATTERNS.items())]
    long_run = _RUN + "{" + str(settings.shortest) + ",}"
    runs = matched(text, long_run, 0, settings.shortest, len(PATTERNS)).alias("runs")
    found = texts.select("doc_id", *sides, runs)

    def short(spans: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.transform(
            F.array_sort(spans),
            lambda s: F.struct(s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end")),
        )

    def likely(s: Column) -> Column:
        return let(
            ratio(s["match"], model),
            lambda x: (x >= settings.total) & (x >= settings.mean * F.length(s["match"])),
        )

    base = F.concat(*map(F.col, PATTERNS))
    free = F.filter(
        "runs",
        lambda s: likely(s) & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return (
        found.select("doc_id", base.alias("base"), "runs")
        .select("doc_id", "base", F.concat("base", free).alias("spans"))
        .select("doc_id", short(F.col("base")).alias("base"), short(F.col("spans")).alias("spans"))
    )
