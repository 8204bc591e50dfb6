import hashlib
import random
from collections import Counter
from dataclasses import replace

from rankmatch.llm import imatch
from rankmatch.operators import joins
from tests.llm.helpers import docs, edge_rows, empty, rows_of


def corpus(n=300):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    chosen = [rng.choices(words, k=rng.randint(1, 60), weights=[1 / (i + 1) for i in range(400)]) for _ in range(n)]
    return [(i * 3 % 301, " ".join(c), "en", "s") for i, c in enumerate(chosen)]


SETTINGS = imatch.Settings(least=0.02, most=0.3)


def test_lexicon_is_the_exact_band(spark, monkeypatch):
    rows = corpus()
    df = {}
    for _, text, _, _ in rows:
        for w in set(text.split()):
            df[w] = df.get(w, 0) + 1
    want = {w.encode() for w, n in df.items() if 0.02 * len(rows) <= n <= 0.3 * len(rows)}
    table = docs(spark, rows).repartition(3)
    assert set(imatch.lexicon(table, SETTINGS).members) == want
    monkeypatch.setattr(imatch, "MAX_CANDIDATES", 0)
    assert set(imatch.lexicon(table, SETTINGS).members) == want


def test_a_large_lexicon_gives_the_same_by_joins(spark):
    rows = [*corpus(), *edge_rows(), *[(900 + i, "same text of many rows", "en", "s") for i in range(40)]]
    rows += [(2000, "words nobody else has", "en", "s")]
    table = docs(spark, rows).repartition(5)
    for whole in (True, False):
        narrow = imatch.lexicon(table, imatch.Settings(least=0.02, most=0.3, whole=whole))
        wide = imatch.lexicon(table, imatch.Settings(least=0.02, most=0.3, whole=whole, max_terms=3))
        assert isinstance(narrow, imatch.Lexicon) and isinstance(wide, imatch.WideLexicon)
        inside = {bytes(r.term) for r in wide.table.where("inside").collect()}
        assert inside == set(narrow.members) and len(inside) > 3
        assert rows_of(imatch.compare_edited(table, wide)) == rows_of(imatch.compare_edited(table, narrow))
        assert rows_of(imatch.fingerprints(table, wide)) == rows_of(imatch.fingerprints(table, narrow))
    bare = narrow.fingerprint(b"words nobody else has")
    assert bare == narrow.fingerprint(b"")


def test_hot_terms_of_a_large_lexicon_are_spread(spark, monkeypatch):
    table = docs(spark, corpus()).repartition(5)
    narrow, wide = imatch.lexicon(table, SETTINGS), imatch.lexicon(table, replace(SETTINGS, max_terms=3))
    want = rows_of(imatch.fingerprints(table, narrow))
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 4000)
    assert rows_of(imatch.fingerprints(table, wide)) == want


def test_edited_texts_in_order(spark):
    rows = corpus()
    table = docs(spark, rows)
    words = imatch.lexicon(table, SETTINGS)
    got = {r.doc_id: r for r in imatch.compare_edited(table, words).collect()}
    ordered = sorted(rows)
    assert len(got) == len(rows)
    for (i, text, _, _), (_, after, _, _) in zip(ordered, [*ordered[1:], ordered[0]]):
        new = imatch.edited(text, after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == words.fingerprint(text.encode())
        assert r.edited_fingerprint == words.fingerprint(new.encode())
        assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == imatch.likeness(r.fingerprint, words.fingerprint(after.encode()))


def test_rows_of_one_id_are_cut_into_runs_too(spark):
    rows = [(None, f"text {i}", "en", "s") for i in range(600)] + [(i, f"other {i}", "en", "s") for i in range(1200)]
    rows += [(700, f"more {i}", "en", "s") for i in range(600)] + [(-5, "same", "en", "s")] * 3
    table = docs(spark, rows).repartition(4)
    found = imatch.in_order(table, run_docs=100).collect()
    own, tails = [r for r in found if not r.tail], [r for r in found if r.tail]
    sizes = Counter(r.run for r in own)
    assert len(own) == len(rows) and max(sizes.values()) <= 250
    # A run has its copy of the next one's first row once, or once a batch where equal rows are the first.
    assert len(tails) <= len(sizes) + 3
    hashes = {r.text: r.h for r in table.selectExpr("text", "xxhash64(text) AS h").collect()}

    def place(row):
        return (-(1 << 63) if row.doc_id is None else row.doc_id, hashes[row.text], row.text)

    heads = {}
    for r in own:
        heads[r.run] = min(heads.get(r.run, place(r)), place(r))
    ordered = sorted(sizes)
    assert [heads[n] for n in ordered] == sorted(heads.values())
    for run, after in zip(ordered, [*ordered[1:], ordered[0]]):
        assert {place(t) for t in tails if t.run == run} == {heads[after]}
    words = imatch.lexicon(table, SETTINGS)
    texts = sorted(map(place, own))
    want = Counter(
        (p[0], hashlib.sha256(imatch.edited(p[2], q[2]).encode()).hexdigest()) for p, q in zip(texts, [*texts[1:], texts[0]])
    )
    got = imatch.compare_edited(table, words).collect()
    assert Counter((-(1 << 63) if r.doc_id is None else r.doc_id, r.edited_sha256) for r in got) == want


def test_fingerprint_is_of_the_set_of_terms():
    words = imatch.Lexicon.of([b"a", b"b", b"c"], imatch.Settings())
    assert words.fingerprint(b"a b zzz") == words.fingerprint(b"yyy B a A")
    assert words.fingerprint(b"a b") != words.fingerprint(b"a c")
    assert words.fingerprint(b"only others") != words.fingerprint(b"rest of them")
    assert words.fingerprint(b"") == words.fingerprint(b" \n")
    assert imatch.likeness(words.fingerprint(b""), words.fingerprint(b"a")) == 0.0


def test_edge_rows(spark):
    table = docs(spark, edge_rows())
    words = imatch.lexicon(table)
    assert imatch.compare_edited(table, words).count() == len(edge_rows())
    prints = [r.fingerprint for r in imatch.fingerprints(table, words).where("doc_id = 4").collect()]
    assert len(prints) == 2 and len(set(prints)) == 1
    one = docs(spark, [(1, "a b c d", "en", "s")])
    r = imatch.compare_edited(one, imatch.lexicon(one)).first()
    assert r.edited_sha256 == hashlib.sha256(b"a b c a").hexdigest()


def test_empty_table(spark):
    table = empty(spark)
    assert imatch.compare_edited(table, imatch.lexicon(table)).count() == 0
