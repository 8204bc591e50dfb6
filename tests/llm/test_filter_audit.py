import random
from itertools import permutations

import numpy as np

from rankmatch.llm import filter_audit
from tests.llm.helpers import WORD, docs, edge_rows, empty, rows_of


def fails(text, is_copy):
    words = WORD.findall(text)
    tests = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
        is_copy,
    )
    return {f for f, t in zip("ABCDE", tests) if t}


def slow(rows, labels):
    first = {}
    for i, t, _, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, t, lang, _ in rows:
        mask = fails(t or "", i is not None and i > first[t or ""])
        parts.setdefault(lang or "", []).append((mask, i in good, i in toxic))
    found = []
    for part, members in parts.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = list(members)
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                removed_by[f] += len(gone)
                failed = sum(f in m[0] for m in members)
                lines.append((order, step, len(left), len(gone), failed - len(gone), sum(m[0] == {f} for m in members),
                              sum(m[1] for m in gone), sum(m[2] for m in gone)))
        found += [(part, *line, removed_by[line[0][line[1] - 1]]) for line in lines]
    return sorted(found, key=repr)


def labels_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def corpus():
    rng = random.Random(51)
    texts = ["", None, "ONE # two", " ".join(f"w{i}" for i in range(120)), " ".join(["a"] * 150), "A" * 30 + " b" * 200]
    texts += [" ".join(rng.choice(["x", "Yes", "No", f"n{i}", "|"]) for i in range(rng.randint(0, 260))) for _ in range(25)]
    rows = [(rng.choice([None, *range(200)]) if rng.random() < 0.1 else i, rng.choice(texts), rng.choice(["en", "de", None]), "s") for i in range(300)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 0)]
    return rows, labels


def audit(spark, rows, labels):
    return filter_audit.audit(filter_audit.masks(docs(spark, rows).repartition(5), labels_table(spark, labels)))


def test_audit_equals_brute_force(spark):
    rows, labels = corpus()
    assert rows_of(audit(spark, rows, labels)) == slow(rows, labels)


def test_removal_steps_are_the_smallest_positions():
    names, places = filter_audit.orders("ABC")
    masks = np.array([[bool(m >> i & 1) for i in range(3)] for m in range(8)])
    steps = filter_audit.removal_steps(masks, places)
    for m in range(8):
        for o, name in enumerate(names):
            hit = [name.index(f) + 1 for i, f in enumerate("ABC") if m >> i & 1]
            assert steps[m, o] == min(hit) if hit else steps[m, o] > 3


def test_most_rows_are_copies(spark):
    rows = [(i, "the same Text # " * (40 if i % 3 else 1), "en", "s") for i in range(150)]
    assert rows_of(audit(spark, rows, [(3, 1, 1)])) == slow(rows, [(3, 1, 1)])


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows()
    assert rows_of(audit(spark, rows, [(1, 1, 0), (4, 1, 1)])) == slow(rows, [(1, 1, 0), (4, 1, 1)])
    assert audit(spark, [], []).count() == 0
    assert rows_of(audit(spark, rows, [])) == slow(rows, [])
