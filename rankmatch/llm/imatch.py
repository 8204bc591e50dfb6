"""I-Match document fingerprints.

Terms within a band of inverse document frequency form the lexicon: neither the words every
document has nor those hardly any has.  A document's distinct terms of the lexicon, sorted, are
hashed as a whole and once for each of several random subsets of the lexicon.  Two documents
are alike as far as the hashes of their subsets agree; a document that was edited a little still
agrees in the subsets that hold none of the edited terms.

The lexicon is exact and covers all documents, in two passes.  The first passes on the terms that
are frequent in a run of a few thousand documents, with their counts.  In every other run a term
has less than a known share, so these counts bound what it can have in all documents; the second
pass counts the terms whose bound reaches the band's lower end, which are few more than the
lexicon.  With ``d`` distinct terms in a document on average and a lower end of
``s``, the lexicon has at most d / s terms whatever the corpus, so it can be broadcast.  A lexicon
of more than ``max_terms`` terms stays a table, and the terms of the distinct texts are joined to it
by a shuffle; the band and the fingerprints are the same either way.

Defined results: a null or empty text has no terms, and all such texts one fingerprint; a text
without a term of the lexicon is fingerprinted by all its terms, or with ``whole=False`` like an
empty one; equal texts have equal
fingerprints whatever their ids; rows without an id come first in the order of documents, and
rows of one id in the order of their texts' hashes; the only document of a table is its own next one;
a text of any length is fingerprinted whole; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmatch.llm.common import WORD, Shared, by_texts, plain
from rankmatch.operators.joins import ROWS, attach_stored
from rankmatch.session import store

# Candidates that are frequent in some run of documents are counted by tasks that hold them all,
# up to this number of them; beyond, all terms are counted by a shuffle.
MAX_CANDIDATES = 1_000_000
_RUN_DOCS, _RUN_BYTES = 4096, 1 << 25
# A term is passed on if its share of a run is at least this part of the band's lower end.
_SLACK = 0.75
_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Settings:
    """``least`` and ``most``: band of the share of documents a term of the lexicon occurs in, that is an
    inverse document frequency from log(1 / most) to log(1 / least).  ``rates``: share of the lexicon
    in each random subset, falling; there are ``repeats`` subsets of every rate.  ``max_terms``: terms of a
    lexicon that is broadcast; it decides the work and never the result.  ``whole``: a text without a term
    of the lexicon is fingerprinted by all its terms.
    """

    least: float = 0.001
    most: float = 0.05
    max_terms: int = 400_000
    rates: tuple[float, ...] = (1 / 16, 1 / 32, 1 / 64, 1 / 128, 1 / 256, 1 / 512, 1 / 1024)
    repeats: int = 8
    seed: int = 42
    whole: bool = True

    @property
    def subsets(self) -> list[float]:
        return [r for r in self.rates for _ in range(self.repeats)]


def terms(text: bytes) -> set[bytes]:
    """Distinct words of a text, A-Z lower-cased."""
    return set(text.lower().split())


def _subsets_of(term: bytes, settings: Settings) -> tuple[int, ...]:
    """Numbers of the random subsets a term belongs to, drawn by a seeded hash of the term."""
    wanted = settings.subsets
    drawn = hashlib.shake_128(settings.seed.to_bytes(8, "little") + term).digest(4 * len(wanted))
    numbers = np.frombuffer(drawn, "<u4")
    return tuple(np.flatnonzero(numbers < np.array(wanted) * 2.0**32).tolist())


@dataclass
class Lexicon:
    """Terms in the band and the subsets that hold each."""

    settings: Settings
    members: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    @classmethod
    def of(cls, found: Iterable[bytes], settings: Settings) -> Lexicon:
        return cls(settings, {t: _subsets_of(t, settings) for t in found})

    def fingerprint(self, text: bytes) -> str:
        """Eight hex digits of the whole lexicon and of each subset; all zero where a subset has no term."""
        own = terms(text)
        kept = own & self.members.keys()
        if kept or not self.settings.whole:
            return hashed(kept, self.members, self.settings)
        return hashed(own, {t: _subsets_of(t, self.settings) for t in own}, self.settings)


@dataclass
class WideLexicon:
    """A lexicon too large to broadcast: a stored table of ``term``, its documents ``__rows`` and whether it is ``inside``.

    Terms above the band are in the table too, so that joins know the hot ones.
    """

    settings: Settings
    table: DataFrame


def hashed(kept: Iterable[bytes], of: Mapping[bytes, tuple[int, ...]], settings: Settings) -> str:
    """The fingerprint of a set of terms, ``of`` naming the subsets of each."""
    kept = sorted(kept)
    held: dict[int, list[bytes]] = {}
    for term in kept:
        for k in of[term]:
            held.setdefault(k, []).append(term)
    parts = [b" ".join(kept), *(b" ".join(held.get(k, ())) for k in range(len(settings.subsets)))]
    return "".join(f"{xxhash.xxh32_intdigest(p) or 1:08x}" if p or not i else "00000000" for i, p in enumerate(parts))


def likeness(a: str, b: str, repeats: int = Settings.repeats) -> float:
    """How alike two fingerprints are, from 0 to 1; 1 for equal ones.

    Small subsets of the lexicon, that hold about one term of either document, agree as often as
    the documents share terms.  So the share of equal hashes is taken over the subsets of the
    smallest size of which half still hold a term, and of all smaller ones that do.
    """
    if a == b:
        return 1.0
    pairs = [(a[i : i + 8], b[i : i + 8]) for i in range(8, len(a), 8)]
    held = [x != "00000000" or y != "00000000" for x, y in pairs]
    sizes = range(0, len(pairs), repeats)
    first = max((k for k in sizes if 2 * sum(held[k : k + repeats]) >= repeats), default=0)
    some = [x == y for (x, y), h in zip(pairs[first:], held[first:]) if h]
    return sum(some) / len(some) if some else 0.0


def _frequent_in_runs(share: float):
    """Terms with at least that share of a run of documents, and by how many they exceed it.

    A null term tells a run's documents.
    """

    def run(batches):
        seen, docs, size = Counter(), 0, 0

        def told():
            low = share * docs
            kept = [(t, n - low) for t, n in seen.items() if n >= low]
            zeros = [0] * len(kept)
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *(t for t, _ in kept)], pa.binary()), pa.array([0.0, *(x for _, x in kept)]),
                 pa.array([docs, *zeros], pa.int64())],
                names=["term", "above", "docs"],
            )

        for batch in batches:
            for text in pc.cast(batch.column(0), pa.large_binary()).to_pylist():
                seen.update(terms(text))
                docs, size = docs + 1, size + len(text)
                if docs >= _RUN_DOCS or size >= _RUN_BYTES:
                    yield told()
                    seen, docs, size = Counter(), 0, 0
        if docs:
            yield told()

    return run


def _counted(candidates):
    def run(batches):
        wanted, seen = candidates.value, Counter()
        for batch in batches:
            for text in pc.cast(batch.column(0), pa.large_binary()).to_pylist():
                seen.update(terms(text) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"]
        )

    return run


def lexicon(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> Lexicon | WideLexicon:
    """The terms of all documents within the band, as a table if there are more than ``max_terms``."""
    spark = docs.sparkSession
    texts = plain(docs, text_col, text_col).select("text")
    share = _SLACK * settings.least
    found = by_texts(texts, _frequent_in_runs(share), "term binary, above double, docs bigint")
    found = store(found, "runs")
    total = found.agg(F.sum("docs")).first()[0]
    if not total:
        return Lexicon(settings)
    least = settings.least
    # What a term has at most: what exceeds the share where it was passed on, and the share of all documents.
    above = found.where("term IS NOT NULL").groupBy("term").agg(F.sum("above").alias("above"))
    possible = above.where(F.col("above") + share * total >= least * total - 1e-6)
    candidates = store(possible.select("term"), "candidates")
    if candidates.count() <= MAX_CANDIDATES:
        shared = spark.sparkContext.broadcast({bytes(r.term) for r in candidates.toLocalIterator()})
        parts = by_texts(texts, _counted(shared), "term binary, n bigint")
        counts = parts.groupBy("term").agg(F.sum("n").alias("n"))
    else:
        lower = F.translate("text", _LOWER, _LOWER.lower())
        words = F.array_distinct(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)))
        each = texts.select(F.explode(words).alias("term")).select(F.col("term").cast("binary").alias("term"))
        counts = each.groupBy("term").agg(F.count("*").alias("n"))
    inside = (F.col("n") <= settings.most * total).alias("inside")
    known = store(counts.where(F.col("n") >= least * total).select("term", F.col("n").alias(ROWS), inside), "lexicon")
    band = known.where("inside").select("term")
    if band.count() > settings.max_terms:
        return WideLexicon(settings, known)
    return Lexicon.of(sorted(bytes(r.term) for r in band.collect()), settings)


def marks(texts: DataFrame, words: WideLexicon) -> DataFrame:
    """``key`` and ``fingerprint`` of a stored table of distinct (``key``, ``text``).

    A row for each distinct term of a text is joined to the lexicon, hot terms spread; what a text keeps,
    no more than its own distinct terms, comes back to it by its key.
    """
    settings = words.settings

    def each(batches):
        for batch in batches:
            for key, text in zip(batch.column(0), pc.cast(batch.column(1), pa.large_binary()).to_pylist()):
                own = sorted(terms(text))
                yield pa.RecordBatch.from_arrays([pa.repeat(key, len(own)), pa.array(own, pa.binary())], names=["key", "term"])

    def run(batches):
        for batch in batches:
            found = []
            for text, kept in zip(pc.cast(batch.column(1), pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                if kept is None:
                    kept = terms(text) if settings.whole else ()
                found.append(hashed(kept, {t: _subsets_of(t, settings) for t in kept}, settings))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["key", "fingerprint"])

    joined = attach_stored(by_texts(texts, each, "key string, term binary"), words.table, ["term"], "inner")
    kept = joined.where("inside").groupBy("key").agg(F.collect_list("term").alias("kept"))
    return by_texts(texts.join(kept, "key", "left").select("key", "text", "kept"), run, "key string, fingerprint string")


def fingerprints(
    docs: DataFrame, words: Lexicon | WideLexicon, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``fingerprint`` of every row."""
    texts = plain(docs, id_col, text_col)
    if isinstance(words, WideLexicon):
        keyed = store(texts.withColumn("key", F.sha2("text", 256)), "keyed")
        distinct = store(keyed.groupBy("key").agg(F.first("text").alias("text")), "distinct")
        made = store(marks(distinct, words), "marks")
        found = attach_stored(keyed.select("doc_id", "key"), made, ["key"], "left")
        return found.select("doc_id", "fingerprint")
    shared = Shared(docs.sparkSession, words)

    def run(batches):
        for batch in batches:
            found = [shared.value.fingerprint(t) for t in pc.cast(batch.column(1), pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fingerprint"])

    return by_texts(texts, run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, fingerprint string")


_FIRST = -(1 << 63)


class _Bounds:
    """Where runs begin: after the rows before an id and, for an id cut m times, at each m-th of the hashes."""

    def __init__(self, cuts: Iterable[int]):
        found = sorted(Counter(cuts).items())
        self.ids = np.array([c for c, _ in found], np.int64)
        self.before = np.cumsum([0, *(m for _, m in found)])
        # A step of 0 stands for the whole range of hashes.
        self.steps = np.array([0, *((1 << 64) // m + 1 if m > 1 else 0 for _, m in found)], np.uint64)

    def runs(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Number of the run of every (id, hash of the text)."""
        at = np.searchsorted(self.ids, keys, "right")
        own = np.zeros(len(keys), bool)
        own[at > 0] = self.ids[at[at > 0] - 1] == keys[at > 0]
        steps = np.where(own, self.steps[at], np.uint64(0))
        rising = hashes.view(np.uint64) ^ np.uint64(1 << 63)
        part = np.where(steps > 0, rising // np.maximum(steps, np.uint64(1)), np.uint64(0)).astype(np.int64)
        return np.where(own, self.before[at - 1] + part + 1, self.before[at]).astype(np.int32)


def in_order(docs: DataFrame, run_docs: int = 1024, max_runs: int = 20_000) -> DataFrame:
    """``run``, ``tail``, ``doc_id`` and ``text``, dealt so that every document lies before its next one.

    Rows are in the order of their ids, and those of one id in the order of their texts' hashes.  They are cut
    into runs at the ids' quantiles; an id that takes several quantiles, above all the missing one, is cut by the
    hashes too, so only equal rows must share a run.  A run lies in one partition, sorted, and ends with
    a copy of the next run's first document, marked as ``tail``; after the last comes the first.
    Texts are shuffled once.  Only the runs' bounds reach the driver, ``max_runs`` at most; sorting a
    run spills, and the scan after it holds two texts.
    """
    texts = plain(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = texts.withColumns({"key": F.coalesce("doc_id", F.lit(_FIRST)), "hash": F.xxhash64("text")})
    runs = min(max(-(-texts.count() // run_docs), 1), max_runs)
    shares = [i / runs for i in range(1, runs)]
    found = keyed.agg(F.percentile_approx("key", shares, 8 * runs)).first()[0] if shares else None
    bounds = _Bounds(found or [])

    @F.pandas_udf("int")
    def run_of(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(bounds.runs(keys.to_numpy(np.int64), hashes.to_numpy(np.int64)))

    own = keyed.select("key", "hash", run_of("key", "hash").alias("run"))
    heads = sorted(own.groupBy("run").agg(F.min(F.struct("key", "hash")).alias("first")).collect())
    numbers = np.array([r.run for r in heads], np.int64)
    first_keys = np.array([r.first.key for r in heads], np.int64)
    first_hashes = np.array([r.first.hash for r in heads], np.int64)

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        k, h = keys.to_numpy(np.int64), hashes.to_numpy(np.int64)
        own = bounds.runs(k, h)
        at = np.searchsorted(numbers, own)
        # Of equal rows at the begin of a run, one in a batch is copied.
        head = (first_keys[at] == k) & (first_hashes[at] == h) & ~pd.DataFrame({"k": k, "h": h}).duplicated().to_numpy()
        return pd.Series([[int(o), int(b)] if f else [int(o)] for o, b, f in zip(own, numbers[at - 1], head)])

    return (
        keyed.select("doc_id", "text", "key", "hash", F.posexplode(places("key", "hash")).alias("tail", "run"))
        .repartition("run")
        .sortWithinPartitions("run", "tail", "key", "hash", "text")
        .select("run", "tail", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _in_pairs(batches):
    """Every document's text and edited text, with their keys and the next document's."""
    names = ["doc_id", "n_chars", "own", "edited", "next", "text", "edited_text"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5]
    before = None
    for batch in batches:
        rows = []
        for number, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            key = hashlib.sha256(text.encode()).hexdigest()
            if before and before[0] == number and not before[1]:
                _, _, last_id, last, last_key = before
                new = edited(last, text)
                rows.append((last_id, len(last), last_key, hashlib.sha256(new.encode()).hexdigest(), key, last, new))
            before = (number, tail, doc_id, text, key)
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _compare_by_join(docs: DataFrame, words: WideLexicon) -> DataFrame:
    """:func:`compare_edited` with a lexicon that stays a table; equal texts are fingerprinted once."""
    schema = "doc_id bigint, n_chars bigint, own string, edited string, next string, text string, edited_text string"
    pairs = store(by_texts(in_order(docs), _in_pairs, schema), "pairs")
    # Every document is the text of a row, so the next ones need no text of their own.
    sides = [F.struct(F.col(k).alias("key"), F.col(t).alias("text")) for k, t in (("own", "text"), ("edited", "edited_text"))]
    both = pairs.select(F.inline(F.array(*sides)))
    distinct = store(both.groupBy("key").agg(F.first("text").alias("text")), "distinct")
    made = store(marks(distinct, words), "marks")
    found = pairs.drop("text", "edited_text")
    for name in ("own", "edited", "next"):
        found = attach_stored(found, made.toDF(name, f"{name}_mark"), [name], "left", pairs.select(name))
    repeats = words.settings.repeats

    def alike(batches):
        for batch in batches:
            own, new, after = (batch.column(i).to_pylist() for i in (3, 4, 5))
            near = [[likeness(a, b, repeats) for a, b in zip(own, other)] for other in (new, after)]
            arrays = [*batch.columns[:5], *[pa.array(n, pa.float64()) for n in near]]
            yield pa.RecordBatch.from_arrays(arrays, names=_COMPARED)

    narrow = found.select("doc_id", "n_chars", "edited", "own_mark", "edited_mark", "next_mark")
    return by_texts(narrow, alike, _COMPARED_DDL)


_COMPARED = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_COMPARED_DDL = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, " \
    "edited_fingerprint string, near_edited double, near_next double"


def compare_edited(docs: DataFrame, words: Lexicon | WideLexicon) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they and the next document's are."""
    if isinstance(words, WideLexicon):
        return _compare_by_join(docs, words)
    shared = Shared(docs.sparkSession, words)
    names = _COMPARED
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]

    def run(batches):
        lexicon_ = shared.value
        repeats = lexicon_.settings.repeats
        before = None
        for batch in batches:
            rows = []
            for number, tail, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = lexicon_.fingerprint(text.encode())
                # Equal ids may bring several tails; what follows a tail has no document before it.
                if before and before[0] == number and not before[1]:
                    _, _, last_id, last, mark = before
                    new = edited(last, text).encode()
                    other = lexicon_.fingerprint(new)
                    rows.append(
                        (last_id, len(last), hashlib.sha256(new).hexdigest(), mark, other,
                         likeness(mark, other, repeats), likeness(mark, own, repeats))
                    )
                before = (number, tail, doc_id, text, own)
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return by_texts(in_order(docs), run, _COMPARED_DDL)
