"""The two classifiers: held-out accuracy, what may and may not be learned from, edge cases."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankmatch.llm import quality_model, toxicity
from rankmatch.llm.common import overlapping, strings
from rankmatch.llm.queries import held_out
from tests.llm.helpers import docs, edge_rows, empty

TABLES = "/root/testdata/sf0.01"
SMALL = quality_model.Settings(bits=12, per_class=100, epochs=3)


def test_gradient_of_one_step_lowers_the_loss():
    texts = ["good plain words here", "BAD!! WORDS!! HERE!!"] * 20
    labels = np.array([1, 0] * 20)
    model = quality_model.fit(texts, labels, 0.5, quality_model.Settings(bits=12, epochs=2))
    odds = quality_model.log_odds(pa.array(texts[:2]), model, quality_model.WordHashes())
    assert odds[0] > 0 > odds[1]


def test_score_does_not_depend_on_the_batch_or_on_blocks(monkeypatch):
    rng = random.Random(19)
    texts = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 300))) for _ in range(50)]
    model = quality_model.fit(texts, np.array([0, 1] * 25), 0.5, quality_model.Settings(bits=10, epochs=1))
    hashes = quality_model.WordHashes()
    whole = quality_model.log_odds(pa.array(texts), model, hashes)
    alone = np.concatenate([quality_model.log_odds(pa.array([t]), model, hashes) for t in texts])
    sliced = quality_model.log_odds(pa.array(["x", *texts, "y"]).slice(1, 50), model, hashes)
    assert np.array_equal(whole, alone) and np.array_equal(whole, sliced)


def test_all_ngrams_are_counted():
    block = np.frombuffer(b"abc abc abc", np.uint8)
    settings = quality_model.Settings(bits=16)
    found = [len(rows) for rows, _ in quality_model.features(block, np.array([0]), settings, quality_model.WordHashes())]
    assert found == [9, 8, 3, 2, 2]


def test_pieces_of_a_long_text_lose_no_ngram():
    rng = random.Random(23)
    settings, hashes = quality_model.Settings(bits=16), quality_model.WordHashes()

    def counted(texts, limit):
        data, ends = strings(pa.array(texts))
        found = Counter()
        for block, starts, owners, seen in overlapping(data, ends, limit):
            for rows, piece in quality_model.features(block, starts, settings, hashes, seen):
                found.update(zip(owners[piece].tolist(), rows.tolist()))
        return found

    for _ in range(30):
        texts = ["".join(rng.choice("ab é \n") for _ in range(rng.randint(0, 400))) for _ in range(6)]
        assert counted(texts, 64) == counted(texts, 1 << 20)


def test_score_of_a_text_is_the_mean_over_its_ngrams_one_by_one():
    """A plain version with a loop per n-gram; only the hashes are shared."""
    settings, hashes = quality_model.Settings(bits=10, epochs=2), quality_model.WordHashes()
    texts = ["good plain words", "bad bad words é", "", "x"] * 5
    model = quality_model.fit(texts, np.array([1, 0, 1, 0] * 5), 0.5, settings)

    def row(block, which, at):
        found = list(quality_model.features(np.frombuffer(block, np.uint8), np.array([0]), settings, hashes))
        return model.table[int(found[which][0][at])]

    for text in ["good words words", "x y", "é"]:
        raw, parts = text.encode(), []
        for k, n in enumerate((3, 4)):
            parts += [row(b"    " + raw[i : i + n], k, 4) for i in range(len(raw) - n + 1)]
        words = raw.split()
        parts += [row(b"    " + w, 2, 0) for w in words]
        parts += [row(b"    " + a + b" " + b, 3, 0) for a, b in zip(words, words[1:])]
        parts += [model.table[1] for a, b in zip(words, words[1:]) if a == b]
        got = quality_model.log_odds(pa.array([text]), model, hashes)[0]
        assert got == pytest.approx(model.bias + sum(parts) / max(len(parts), 1), abs=1e-6)


def test_gradient_equals_finite_differences():
    """One step from the drawn start moves vectors and layer against the slope of the loss."""
    settings = quality_model.Settings(bits=6, dim=3, epochs=1, rate=0.001)
    hashes, size = quality_model.WordHashes(), 64
    texts, labels = ["aa bb", "cc dd ee"], np.array([1, 0])
    random_ = np.random.default_rng(settings.seed)
    vectors = random_.normal(0, 0.05, (size, 3)).astype(np.float32).astype(float)
    layer = random_.normal(0, 1, (3, 2)).astype(np.float32).astype(float)
    order = random_.permutation(2)

    def loss(v, w, offset, i):
        rows, weights = quality_model._document(texts[i], settings, hashes)
        out = (weights @ v[rows]) @ w + offset
        return np.log(np.exp(out).sum()) - out[labels[i]]

    def slope(f, x):
        found = np.zeros_like(x)
        for at in np.ndindex(*x.shape):
            up, down = x.copy(), x.copy()
            up[at] += 1e-5
            down[at] -= 1e-5
            found[at] = (f(up) - f(down)) / 2e-5
        return found

    offset = np.zeros(2)
    for step, i in enumerate(order):
        rate = settings.rate * (1 - step / 2)
        dv = slope(lambda x: loss(x, layer, offset, i), vectors)
        dw = slope(lambda x: loss(vectors, x, offset, i), layer)
        do = slope(lambda x: loss(vectors, layer, x, i), offset)
        vectors, layer, offset = vectors - rate * dv, layer - 0.001 * rate * dw, offset - 0.001 * rate * do
    model = quality_model.fit(texts, labels, 0.5, settings)
    assert np.allclose(model.table, vectors @ (layer[:, 1] - layer[:, 0]), atol=1e-5)
    assert model.bias == pytest.approx(offset[1] - offset[0], abs=1e-7)


@pytest.mark.parametrize("operator, most", [(quality_model, 10), (toxicity, 10)])
def test_an_id_on_many_rows_brings_one_text_to_the_driver(spark, monkeypatch, operator, most):
    rows = [(1, f"text {i}", "en", "a") for i in range(3000)] + [(i, f"other {i}", "en", "a") for i in range(2, 40)]
    rows.append((40, "long " * 9000, "en", "a"))
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, quality int")
    taken = []
    monkeypatch.setattr(operator, "fit", lambda texts, labels, share, settings: taken.append((texts, labels)))
    operator.train(docs(spark, rows), known, "quality", operator.Settings(per_class=most))
    (texts, labels), = taken
    assert len(texts) == len(labels) <= 2 * most and max(map(len, texts)) < 20_000
    operator.train(docs(spark, rows), known, "quality", operator.Settings(per_class=100))
    assert len(taken[1][0]) == 39 and taken[1][0].count("text 0") == 1


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize(
    "operator, label, part, least",
    [(quality_model, "quality", (5, 0), 0.97), (toxicity, "toxic", (3, 1), 0.93)],
)
def test_held_out_accuracy(spark, operator, label, part, least):
    table = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    model = operator.train(table, labels.where(~held_out(*part)), label)
    scores = operator.score(table, model).join(labels, "doc_id").where(held_out(*part)).toPandas()
    threshold = 0.3 if label == "quality" else 0.7
    right = (scores["score"] >= threshold).astype(int) == scores[label]
    assert right.mean() >= least
    if label == "toxic":
        assert (scores[scores.toxic == 0]["score"] < 0.7).all()


def test_held_out_rows_follow_the_checksum(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.h for r in rows.select("doc_id", held_out(3, 1).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(200)}
    assert rows.select(F.lit(None).cast("long").alias("doc_id")).select(held_out(3, 1)).first()[0] is True


@pytest.mark.parametrize("operator, label", [(quality_model, "quality"), (toxicity, "toxic")])
def test_edge_rows_and_missing_labels(spark, operator, label):
    rows = edge_rows()
    table = docs(spark, rows)
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    some = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (99, 0)], f"doc_id long, {label} int")
    for labels in (none, some):
        model = operator.train(table, labels, label)
        got = operator.score(table, model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 4}) == 1
        assert operator.score(empty(spark), model).count() == 0


def test_filter_keeps_whole_rows(spark):
    table = docs(spark, [(1, "good plain words", "en", "a"), (2, "BAD!! BAD!!", "en", "a"), (3, None, "en", "a")] * 30)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality_model.train(table, labels, "quality", SMALL)
    kept = quality_model.keep(table, model, 0.3)
    assert kept.schema == table.schema
    want = {r.doc_id for r in quality_model.score(table, model).where("score >= 0.3").collect()}
    assert {r.doc_id for r in kept.collect()} == want and 1 in want and 2 not in want


def run(words):
    state, out = toxicity.GRAMMAR.start, []
    for w in words:
        state, x = toxicity.GRAMMAR.arcs[state, w]
        out.append(x)
    return out


def test_grammar():
    assert run(["other", "insult"])[-1] == "insult"
    assert run(["target", "other", "insult"])[-1] == "direct insult"
    assert run(["insult", "other", "target"])[-1] == "aimed"
    assert run(["target", "negation", "other", "insult"])[-1] == "soft insult"
    assert run(["negation", "other", "other", "other", "insult"])[-1] == "insult"
    assert run(["target", "report", "insult"])[-1] == "told insult"
    assert run(["quote", "insult", "quote", "insult"])[1::2] == ["told insult", "insult"]
    assert run(["target", "threat"])[-1] == "direct threat"


def test_composition_reads_what_the_first_writes():
    words = [*toxicity.CLASSES]
    rng = random.Random(20)
    parts = [toxicity.negation(), toxicity.reported(), toxicity.targets()]
    for _ in range(300):
        text = [rng.choice(words) for _ in range(12)]
        step = text
        for t in parts:
            state, out = t.start, []
            for w in step:
                state, x = t.arcs[state, w]
                out.append(x)
            step = out
        assert run(text) == step


def test_clauses_and_not_words_are_scored():
    words = toxicity.lexicon([("blorg", True, True)])
    model = toxicity.Model(words, np.array(list(toxicity.PATTERNS.values())), -2.0)
    direct, told, soft = (model.log_odds(t) for t in ("you are a blorgish one", 'he said "blorgish"', "not a blorgish one"))
    assert direct > told > soft > -2.0
    assert model.log_odds("you. he said nothing!") == -2.0 == model.log_odds("")
    # A target in another clause makes nothing direct.
    pattern = lambda t: {n: c for n, c in zip(toxicity.PATTERNS, toxicity.matches(t, words)) if c}
    assert pattern("you. a blorg came by") == {} and pattern("you blorg") == {"direct insult": 1, "outcry": 1}
    assert pattern("Blorg! Go") == {"outcry": 1} and pattern("not blorg!") == {"soft insult": 1}


def test_a_lone_word_scores_nothing_at_any_repetition():
    words = toxicity.lexicon([("blorg", True, True), ("zork", False, False)])
    model = toxicity.Model(words, np.array(list(toxicity.PATTERNS.values())), -2.0)
    for times in (1, 5, 500):
        for text in ("The loser of the match shook hands. ", "To destroy and beat the old wall kills time; "):
            assert model.log_odds(text * times) == -2.0
    pattern = lambda t: {n: c for n, c in zip(toxicity.PATTERNS, toxicity.matches(t, words)) if c}
    assert pattern("the stupid loser of the match came. what a blorgish day") == {"barrage": 2}
    assert pattern("the loser came home" + ". and so on" * 11 + ". with a blorg at home") == {"barrage": 1}
    assert pattern("the loser came home" + ". and so on" * 12 + ". with a blorg at home") == {}
    assert pattern("the old blorg saw the zork here") == {"barrage of slurs": 1}
    # Twice as many matches of a pattern always weigh more.
    assert model.log_odds("you are a blorg. " * 40) > model.log_odds("you are a blorg. " * 20)


def test_repeated_ids_reach_the_driver_once(spark, monkeypatch):
    rows = [(1, f"you are a moron {i}", "en", "a") for i in range(300)] + [(2, "fine", "en", "a"), (3, "x" * 30_000, "en", "a")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, *_: seen.append(texts))
    toxicity.train(docs(spark, rows), labels)
    assert seen == [["you are a moron 0", "fine"]]


def test_learned_stems_explain_toxic_documents():
    rng = random.Random(21)
    fill = ["".join(rng.choice("aeiou") for _ in range(5)) for _ in range(200)]

    def text(*extra):
        return " ".join([*rng.choices(fill, k=60), *extra])

    toxic = [text(f"zork{rng.choice(fill)}") for _ in range(60)]
    other = [text() for _ in range(60)]
    assert toxicity.learned_stems(toxic, other, toxicity.Settings()) == [("zork", True, True)]
