"""Every text query on the smallest tables, and the pipeline stage by stage."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from rankmatch.llm import filter_audit, pii
from rankmatch.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import HAVE_TABLES, SMALL, WORD
from tests.llm.test_simhash import slow_print, slow_roots

pytestmark = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")

COLUMNS = {
    "op1_pii_skip_chain": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op2_html_layout_text": ["page_id", "text", "n_chars"],
    "op3_imatch_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op4_mixing_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_best_fit_packing": ["doc_id", "piece", "first_word", "n_words", "bin_id", "capacity", "begin"],
    "op6_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"],
    "op8_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op9_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op10_toxicity_grammar": ["doc_id", "held_out", "score", "predicted"],
    "op12_shingle_join": ["doc_id", "n_shingles", "component_id"],
}
AUDITS = {
    "op11_source_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op13_filter_audit": ["part", "filter_order", "step", *filter_audit.COUNTS],
}


def test_registry():
    assert {*COLUMNS, *AUDITS} == set(QUERIES) and {*COLUMNS, "pipeline"} <= set(registry.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_covers_its_whole_table(spark, name):
    df = registry.queries()[name](spark, SMALL)
    assert df.columns == COLUMNS[name]
    key = df.columns[0]
    table = spark.read.parquet(f"{SMALL}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    want = {r[0] for r in table.select(key).collect()}
    rows = df.collect()
    assert {r[0] for r in rows} == want
    if name != "op5_best_fit_packing":
        assert len(rows) == table.count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = registry.queries()[name](spark, SMALL)
    want = con.execute(registry.oracle_sql()[name])
    assert {**COLUMNS, **AUDITS}[name] == df.columns and [d[0] for d in want.description] == df.columns
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())


def test_digests_of_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in registry.queries()["op1_pii_skip_chain"](spark, SMALL).collect():
        base, _ = pii.pattern_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(map(pii.written, ([s] for s in base))) <= set(r.spans.split(",")) if base else True


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    kept = corpus_pipeline.quality(spark, docs, SMALL).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert kept.schema == docs.schema and sum(labels.get(i, 1) for i in ids) > 0.9 * sum(labels.values())
    assert all(i in ids for i, q in labels.items() if q) or len(ids) > 0.8 * docs.count()

    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    prints = [slow_print(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    want = {rows[r][0] for r in slow_roots(pairs, range(len(rows))).values()}
    single = corpus_pipeline.near_dedup(spark, kept, SMALL).cache()
    assert {r.doc_id for r in single.collect()} == want and single.count() == len(want)

    clean = corpus_pipeline.private(spark, single, SMALL).cache()
    assert clean.count() == len(want) and clean.columns == docs.columns
    assert all(pii.pattern_spans(r.text)[0] == [] for r in clean.collect())

    mixed = corpus_pipeline.mixed(spark, clean, SMALL).cache()
    size = lambda rows: sum(len(WORD.findall(r.text)) for r in rows)
    assert abs(size(mixed.collect()) - size(clean.collect())) <= 20

    packed = corpus_pipeline.packed(spark, mixed, SMALL).collect()
    assert sum(r.n_words for r in packed) == size(packed) == size(mixed.collect())
    assert {i for r in packed for i in r.doc_ids} == {r.doc_id for r in mixed.collect()}


def test_pipeline_runs(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "PII", "mixing sources", "best-fit packing",
    ]
    assert corpus_pipeline.run(spark, SMALL).count() > 0
