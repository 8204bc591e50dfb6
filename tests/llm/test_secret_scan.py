import random
import re
import string

import pytest
from pyspark.sql import functions as F

from rankmatch.llm import secret_scan
from tests.llm.helpers import docs, edge_rows, empty

EXPRESSIONS = {
    "assign": r"""(?ia:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": (1, 6), "access": (0, 20), "hex": (0, 24)}
PROSE = "the settings of this application are described in the configuration file called default parameters "


def brute(text):
    found = []
    for number, (kind, expression) in enumerate(EXPRESSIONS.items()):
        group, least = LEAST[kind]
        found += [(m.start(), number, m.end(), kind) for m in re.finditer(expression, text) if len(m[group]) >= least]
    return [(s, k, e) for s, _, e, k in sorted(found)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, PROSE * 3 + f"number {i}", "en", "s") for i in range(50)]
    return secret_scan.train(docs(spark, rows))


def test_patterns_equal_plain_expressions(spark, model):
    rng = random.Random(9)
    parts = ["token", '="', "AKIA", ": ", "Secret", "é", "😀", "0a1b2c3d4e5f", "ABCDEFGHIJKLMNOPQR", " ", "\n", "x", "api_key:"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))), "en", "s") for i in range(1500)]
    got = {r.doc_id: [tuple(s) for s in r.base] for r in secret_scan.scan(docs(spark, rows), model).collect()}
    for i, text, _, _ in rows:
        assert got[i] == brute(text), text


def test_models_tell_random_strings_from_identifiers(spark, model):
    random_ones = ["wJalrXUtnFEMIK7MDENGbPxRfiCYzzAMPLEKEY", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"]
    plain_ones = ["internationalization_of_the_application", "-" * 40, "k" * 30, "thenumberoftheparameters"]
    text = " ".join(x for pair in zip(random_ones, plain_ones) for x in pair) + " " + " ".join(plain_ones[2:])
    r = secret_scan.scan(docs(spark, [(1, text, "en", "s")]), model).first()
    assert r.base == [] and [text[s.start : s.end] for s in r.spans] == random_ones
    assert {s.kind for s in r.spans} == {"markov"}


def test_added_spans_touch_no_pattern(spark, model):
    text = "password = wJalrXUtnFEMIK7MDENGbPxRfiCYzzAMPLEKEY and 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    r = secret_scan.scan(docs(spark, [(1, text, "en", "s")]), model).first()
    assert r.spans == r.base and [s.kind for s in r.base] == ["assign", "hex"]


def test_running_sums(spark):
    for n in (0, 1, 7, 8, 9, 64, 65, 1000):
        values = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x) if n else F.array().cast("array<int>")
        got = spark.range(1).select(secret_scan.prefix_sums(values).alias("s")).first().s
        assert got == [k * (k + 1) // 2 for k in range(1, n + 1)]


def test_running_sums_of_over_two_million_numbers(spark):
    n = 8**7 + 1
    sums = secret_scan.prefix_sums(F.array_repeat(F.lit(1), F.col("n")))
    got = spark.range(1).select(F.lit(n).alias("n")).select(F.element_at(sums, -1).alias("s")).first().s
    assert got == n


def test_plan_has_no_python(spark, model):
    plan = secret_scan.scan(docs(spark, edge_rows()), model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_edge_rows_and_empty_table(spark, model):
    rows = edge_rows()
    got = secret_scan.scan(docs(spark, rows), model).collect()
    assert len(got) == len(rows)
    assert all(r.base == [] for r in got)
    assert secret_scan.scan(empty(spark), secret_scan.train(empty(spark))).count() == 0


def test_short_random_strings_are_found_and_names_are_not(spark):
    rng = random.Random(77)
    prose = "the service reads customer records from the shared folder and writes daily reports about every order "
    table = docs(spark, [(i, prose * 3 + f" row {i}", "en", "a") for i in range(200)])
    model = secret_scan.train(table)
    notations = (string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits)
    keys = ["".join(rng.choice(rng.choice(notations[i % 3 : i % 3 + 1])) for _ in range(rng.randint(12, 19))) for i in range(300)]
    names = "customer_id daily_reports_about shared-folder-order getCustomerRecords every_order_service recordsFromFolder"
    rows = [(i, f"x {k} y", "en", "a") for i, k in enumerate(keys)] + [(1000 + i, f"a {n} b", "en", "a") for i, n in enumerate(names.split())]
    got = {r.doc_id: [s["kind"] for s in r.spans] for r in secret_scan.scan(docs(spark, rows), model).collect()}
    assert sum(bool(got[i]) for i in range(300)) > 0.9 * 300
    assert not any(got[1000 + i] for i in range(len(names.split())))


def test_ratio_equals_a_plain_sum(spark):
    table = docs(spark, [(1, "plain words and aB3xK9qLm2Zt8 token: abcdef0123", "en", "a")])
    model = secret_scan.train(table)
    numbers = [float(x) for x in model.split(",")]
    code = {c: i + 1 for i, c in enumerate(secret_scan.ALPHABET)}
    width = len(secret_scan.ALPHABET) + 1
    rng = random.Random(78)
    tokens = ["a", "é-é", *("".join(rng.choice(secret_scan.ALPHABET + ".é") for _ in range(rng.randint(1, 40))) for _ in range(60))]
    frame = spark.createDataFrame([(t,) for t in tokens], "t string")
    for r in frame.select("t", secret_scan.ratio(F.col("t"), model).alias("x")).collect():
        want, before = 0.0, 0
        for c in r.t:
            want, before = want + numbers[before * width + code.get(c, 0)], code.get(c, 0)
        assert abs(r.x - want) < 1e-6
