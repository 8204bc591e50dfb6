import random

from pyspark.sql import functions as F

from rankmatch.llm import mixing
from tests.llm.helpers import WORD, docs, edge_rows, empty, rows_of


def filled(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by clamping one round after the other."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    waiting = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, found = float(sum(sizes.values())), {}
    while waiting:
        level = rest / sum(waiting.values())
        over = [s for s in waiting if epochs * sizes[s] < level * waiting[s]]
        if not over:
            found.update({s: level * w for s, w in waiting.items()})
            break
        for s in over:
            found[s] = float(epochs * sizes[s])
            rest -= found[s]
            del waiting[s]
    return found


def corpus():
    rng = random.Random(4)
    sources = ["hot"] * 6 + ["tiny", "mid", "mid", None, "é", "Z"]
    rows = []
    for i in range(400):
        source = rng.choice(sources)
        n = rng.randint(1, 3) if source == "tiny" else rng.randint(0, 60)
        rows.append((i, " ".join(["w"] * n), "en", source))
    return rows


def check(rows, got):
    sizes, taken = {}, {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = filled(sizes)
    by_id = {r[0]: r for r in rows}
    for r in got:
        source = by_id[r.doc_id][3]
        assert abs(r.target - want[source]) < 1e-6 and r.source_size == sizes[source]
        assert r["size"] == len(WORD.findall(by_id[r.doc_id][1] or "")) and 0 <= r.taken <= 3 * r["size"]
        taken[source] = taken.get(source, 0) + r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 1, source


def test_targets_are_met_to_the_word(spark):
    rows = corpus()
    got = mixing.amounts(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    check(rows, got)
    again = mixing.amounts(docs(spark, rows).repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_sources_by_shuffle_instead_of_broadcast(spark, monkeypatch):
    rows = corpus()
    want = rows_of(mixing.amounts(docs(spark, rows)))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows_of(mixing.amounts(docs(spark, rows))) == want


def test_mixed_rows_hold_the_words_taken(spark):
    rows = corpus()
    table = docs(spark, rows)
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    got = {r[0]: r[1] for r in mixed.groupBy("doc_id").agg(F.sum(words)).collect()}
    want = {r.doc_id: r.taken for r in mixing.amounts(table).where("taken > 0").collect()}
    assert {i: n for i, n in got.items() if n} == want
    assert mixed.where("n_chars <> length(text)").count() == 0


def test_edge_rows(spark):
    rows = edge_rows()
    got = mixing.amounts(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r["size"] for r in got if r.doc_id == 1} == {0}
    twins = [r.taken for r in got if r.doc_id == 4]
    # Equal rows: where the mark falls on them, the first one is taken further than the second.
    assert len(twins) == 2 and max(twins) - min(twins) <= 21
    source = [r for r in got if r.doc_id in (4, 5, None) and r["size"] and r.doc_id != 1]
    assert abs(sum(r.taken for r in source) - source[0].target) < 1
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert mixing.mix(docs(spark, rows)).count() > 0


def test_equal_rows_share_the_mark(spark):
    rows = [(1, "a b c d e", "en", "s")] * 50 + [(2, "x " * 100, "en", "t")]
    got = mixing.amounts(docs(spark, rows)).collect()
    taken = sum(r.taken for r in got if r.doc_id == 1)
    assert abs(taken - got[0].target if got[0].doc_id == 1 else taken - got[-1].target) <= 50


def test_no_words_and_empty_table(spark):
    assert [r.taken for r in mixing.amounts(docs(spark, [(1, None, "en", None), (2, "", "en", "a")])).collect()] == [0, 0]
    assert mixing.amounts(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0


def test_equal_rows_meet_the_target_to_the_word(spark):
    """A source of equal rows only, over several tasks, beside one with rows of its own."""
    for n in (1, 7, 4001):
        rows = [(1, "two words", "en", "same")] * n + [(i, "w " * (i % 5), "en", "z") for i in range(2, 900)]
        rows += [(None, None, "en", None), (None, "a b c", "en", None), (None, "a b c", "en", None)]
        table = docs(spark, rows).repartition(6)
        got = mixing.amounts(table).collect()
        targets = filled({s: sum(len(WORD.findall(r[1] or "")) for r in rows if r[3] == s) for s in ("same", "z", None)})
        taken = {}
        for r in got:
            source = "same" if r.doc_id == 1 else None if r.doc_id is None else "z"
            taken[source] = taken.get(source, 0) + r.taken
            assert r.taken <= 3 * r.size and abs(r.target - targets[source]) < 1e-6
        assert len(got) == len(rows)
        assert all(abs(taken[s] - targets[s]) < 1 for s in targets)
        mixed = mixing.mix(table).groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()
        assert {r.source: r.n for r in mixed} == taken
        assert sorted(map(tuple, mixing.amounts(table).collect()), key=repr) == sorted(map(tuple, got), key=repr)
