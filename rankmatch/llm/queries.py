"""One query per operator over the test tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmatch.llm import (
    filter_audit,
    html_text,
    imatch,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    shingle_join,
    simhash,
    source_divergence,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int):
    """Whether the row's label must not be learned from; a row without id is never learned from."""
    part = F.crc32(F.col("doc_id").cast("string")) % modulus
    return F.coalesce(part == remainder, F.lit(True))


def _written(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query
def op1_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs))
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans")
    )


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    model = quality_model.train(docs, labels, "quality")
    return quality_model.score(docs, model).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in secret_scan.PATTERNS]
    return found.select(
        "doc_id", *counts, F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans")
    )


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3, seed=42)


@query
def op2_html_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.compare_edited(docs, imatch.lexicon(docs))


@query
def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.amounts(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3)


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign(table(spark, sf_dir, "documents"))


@query
def op10_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(3, 1))
    model = toxicity.train(docs, labels, "toxic")
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
full_counts AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept ON g.lang = kept.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (
  SELECT f.lang, f.source, f.term, f.n,
    1 + (1000000000 * (f.n + 5)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 5 * v.v)::BIGINT AS p
  FROM full_counts f JOIN v ON f.lang = v.lang),
l AS (SELECT lang, term, sum(n)::BIGINT AS n FROM full_counts GROUP BY lang, term),
q AS (
  SELECT l.lang, l.term, 1 + (1000000000 * (l.n + 5)) // (sum(l.n) OVER (PARTITION BY l.lang) + 5 * v.v)::BIGINT AS q
  FROM l JOIN v ON l.lang = v.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term
  WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.masks(docs, labels))


ORACLE["op13_filter_audit"] = r"""
WITH known AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents),
f AS (
  SELECT d.part, coalesce(known.good, false) AS good, coalesce(known.toxic, false) AS toxic,
    concat(CASE WHEN len(words) < 100 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS mask
  FROM d LEFT JOIN known ON d.doc_id = known.doc_id),
m AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS s FROM orders),
lost AS (
  SELECT m.*, o, (SELECT min(instr(o, x)) FROM letters WHERE contains(mask, x)) AS hit FROM m, orders),
counted AS (
  SELECT lost.part, steps.o, steps.s, sum(n) FILTER (hit IS NULL OR hit > s) AS kept,
    sum(n) FILTER (hit = s) AS removed, sum(n) FILTER (hit < s AND contains(mask, o[s])) AS redundant,
    sum(n) FILTER (mask = o[s]) AS unique_fails,
    sum(good) FILTER (hit = s) AS good_lost, sum(toxic) FILTER (hit = s) AS toxic_lost
  FROM lost JOIN steps USING (o) GROUP BY ALL)
SELECT part, o AS filter_order, s::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, o[s]), 0)::BIGINT AS shapley
FROM counted
"""


@query
def op12_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=90)


ORACLE["op12_shingle_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS shingles
  FROM d),
e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(shingles) AS n_shingles, min(reach.b) AS component_id
FROM s JOIN reach ON s.doc_id = reach.a GROUP BY s.doc_id, shingles
"""
