import random
import re

import numpy as np
import pytest

from rankmatch.llm import pii
from tests.llm.helpers import docs, edge_rows, empty

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for kind, expression in EXPRESSIONS.items():
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                found.append((kind, *m.span()))
    return pii.ordered(found)


def test_patterns_equal_plain_expressions():
    rng = random.Random(3)
    parts = ["4465758382889437", "1.2.3.4", "256.1.1.1", "a.b@c.d", "@", ".", "+1 (743) 555-3824", " ", "-", "7", "é", "x"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert pii.pattern_spans(text)[0] == brute(text), text


def test_long_texts_are_scanned_in_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" + "(" * 300_000, "@a" * 100_000):
        pii.find([text], pii.prior())


def test_ties_label_what_the_patterns_miss():
    model = pii.prior()
    card = "4465758382889437"
    base, spans = pii.find([f"see {card} {card} x"], model)[0]
    assert base == [] and spans == [("card", 4, 20), ("card", 21, 37)]
    base, spans = pii.find(["call 743-555-3824 or +1 (743) 555-3824 now"], model)[0]
    assert base == [("phone", 21, 38)] and ("phone", 5, 17) in spans
    clean = "order 1234567890123456 of 2024-11-05 12:30, version 1.2.3, pages 10-12"
    assert pii.find([clean], model)[0] == ([], [])


def test_skip_ties_raise_a_weak_mention():
    bits = np.array([1 | 1 << 1, 1 | 1 << 2])
    field = pii.prior()
    alone = pii.probabilities(bits, np.zeros((0, 3), int), field)
    tied = pii.probabilities(bits, np.array([[0, 1, pii.SAME]]), field)
    assert tied[1, 1] > alone[1, 1]


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(1)
    field = pii.Field(rng.normal(size=(len(pii.FEATURES), 7)), rng.normal(size=(7, 7)), np.array([0.7, 0.4]))
    bits, ties = np.array([3, 5, 9]), np.array([[0, 1, pii.CHAIN], [1, 2, pii.SAME]])
    own = pii._matrix(bits) @ field.features
    joint = own[0][:, None, None] + own[1][None, :, None] + own[2][None, None, :]
    joint = joint + field.chain[:, :, None] + field.skip[0] * pii._AGREE[None, :, :]
    joint = np.exp(joint - joint.max())
    joint /= joint.sum()
    want = np.stack([joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))])
    assert np.allclose(pii.probabilities(bits, ties, field, rounds=60), want, atol=1e-6)


def test_result_does_not_depend_on_the_batch():
    texts = ["a 4465758382889437 4465758382889437", "mail x.1@mail.com x.1 x.1@mail.com", "nothing", "7 8 9 10.1.1.1"]
    together = pii.find(texts, pii.prior())
    assert together == [pii.find([t], pii.prior())[0] for t in texts]


def test_scan_and_redact_edge_rows(spark):
    rows = [*edge_rows(), (9, "mail me at jo.9@mail5.example.com or 10.1.2.3", "en", "a")]
    table = docs(spark, rows)
    field = pii.train(table)
    found = pii.scan(table, field).collect()
    assert len(found) == len(rows)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found}
    assert spans[9] == [("email", 11, 33), ("ip", 37, 45)] and spans[4] == []
    clean = pii.redact(table, field)
    assert clean.columns == table.columns and clean.schema == table.schema
    shown = {r.doc_id: r for r in clean.collect()}
    assert shown[9].text == "mail me at <EMAIL> or <IP>" and shown[9].n_chars == len(shown[9].text)
    assert shown[1].text is None and shown[4].text == rows[3][1]


@pytest.mark.parametrize("operator", [pii.scan, pii.redact])
def test_empty_table(spark, operator):
    table = empty(spark)
    assert operator(table, pii.train(table)).count() == 0


def test_training_is_bounded_by_words_and_takes_one_row_of_an_id(spark, monkeypatch):
    rows = [(1, f"call +49 30 1234567{i % 10} now", "en", "a") for i in range(500)]
    rows += [(i, f"mail a{i}@example.org or 10.0.0.{i}", "en", "a") for i in range(2, 102)]
    rows.append((200, "".join(f"n{i} " for i in range(3000)), "en", "a"))
    taken = []
    monkeypatch.setattr(pii, "fit", lambda bits, labels, ties: taken.append((bits, labels, ties)))
    table = docs(spark, rows)
    pii.train(table)
    pii.train(table, max_words=2000)
    pii.train(table, max_words=100)
    pii.train(table.limit(0))
    whole, bounded, few, none = (len(b) + len(t) for b, _, t in taken)
    assert whole > 3000 and all(len(b) == len(x) for b, x, _ in taken)
    assert 0 < bounded <= 2000 and few <= 100 and none == 0
