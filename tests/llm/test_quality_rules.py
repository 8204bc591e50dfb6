import random
from collections import Counter

import numpy as np

from rankmatch.llm import quality_rules
from tests.llm.helpers import WORD, docs, edge_rows, empty


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often, covered, seen, repeated_lines = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated_lines, len(covered)


def test_counts():
    rng = random.Random(10)
    for _ in range(3000):
        text = "".join(rng.choice(["a ", "b ", "\n", "é", "#", " ", "a b a\n", "\x85", "\xa0", "\x1c"]) for _ in range(rng.randint(0, 30)))
        assert quality_rules.counts(text.encode()) == brute(text), repr(text)


def corpus():
    """Two languages of plain prose, a few pages of symbols, and a source too small for itself."""
    rng = random.Random(11)
    rows = []
    for i in range(400):
        lang, source = ("en", "hot") if i % 2 else ("de", f"s{i % 3}")
        if i == 399:
            source = "rare"
        n = int(rng.lognormvariate(5.5, 0.6)) + 60
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]
        if i % 40 == 7:
            words = [w + rng.choice(["###", "|||", "$$$"]) for w in words]
        rows.append((i, " ".join(words), lang, source))
    return rows


def test_outliers_of_each_group_are_rejected(spark):
    rows = corpus()
    got = {r.doc_id: r for r in quality_rules.judge(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, text, _, _ in rows:
        assert tuple(got[i][1:6]) == brute(text)
        assert got[i].kept == (i % 40 != 7), got[i]


def test_estimate_is_that_of_plain_concentration_steps(spark):
    rng = np.random.default_rng(12)
    clean = rng.multivariate_normal(np.zeros(5), np.eye(5) + 0.5, 900)
    bad = rng.normal(8, 0.5, (100, 5))
    data = np.vstack([clean, bad])
    points = spark.createDataFrame([("c", *map(float, r)) for r in data], "cell string, " + ", ".join(f"x{i} double" for i in range(5)))
    settings = quality_rules.Settings()
    r = quality_rules.estimates(points, settings, True).first()
    mean, cov = np.median(data, axis=0), np.diag(np.median(np.abs(data - np.median(data, axis=0)), axis=0) * 1.4826) ** 2
    for _ in range(30):
        off = data - mean
        d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
        inner = data[d <= np.sort(d)[749]]
        mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True) + np.diag(np.array(settings.floor) ** 2)
    assert np.allclose(r.m, mean, atol=0.1)
    assert np.allclose(np.linalg.inv(np.array(r.p).reshape(5, 5)), cov, atol=0.15)
    assert np.abs(np.array(r.m)).max() < 0.5


def estimate(spark, data, settings=quality_rules.Settings()):
    columns = "cell string, " + ", ".join(f"x{i} double" for i in range(5))
    points = spark.createDataFrame([("c", *map(float, r)) for r in data], columns)
    r = quality_rules.estimates(points, settings, True).first()
    return np.array(r.m), np.linalg.inv(np.array(r.p).reshape(5, 5)), r.scale


def test_floor_is_a_minimum_of_the_spread():
    floor = np.array(quality_rules.Settings().floor)
    cov = np.diag((4 * floor) ** 2)
    cov[3, 3] = cov[4, 4] = 0.0
    squares = [cov[i, j] for i, j in quality_rules._MOMENTS]
    _, got, *free = quality_rules._shape(1.0, np.zeros(5), np.array(squares), floor)
    assert np.allclose(got, np.diag([*(4 * floor[:3]) ** 2, *floor[3:] ** 2]))
    assert free == [3]


def test_steps_go_on_until_the_estimate_settles(spark):
    rng = np.random.default_rng(5)
    # A wide cloud around a dense one that is not in the middle of it: the estimate moves slowly.
    data = np.vstack([rng.normal(0, 1, (1200, 5)), rng.normal(0.0, 3, (1600, 5)) + [3, 3, 0, 0, 0]])
    mean, cov, _ = estimate(spark, data)
    off = data - mean
    d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
    inner = data[d <= np.sort(d)[int(0.75 * len(data)) - 1]]
    assert np.linalg.slogdet(np.cov(inner.T, bias=True))[1] > np.linalg.slogdet(cov)[1] - 0.01


def test_groups_by_shuffle_instead_of_broadcast(spark, monkeypatch):
    rows = corpus()[:150]
    want = sorted((r.doc_id, r.kept) for r in quality_rules.judge(docs(spark, rows)).collect())
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 0)
    assert sorted((r.doc_id, r.kept) for r in quality_rules.judge(docs(spark, rows)).collect()) == want


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows()
    table = docs(spark, rows)
    got = quality_rules.judge(table).collect()
    assert len(got) == len(rows)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 7, -8))
    assert quality_rules.keep(table).columns == table.columns
    assert quality_rules.judge(empty(spark)).count() == 0
