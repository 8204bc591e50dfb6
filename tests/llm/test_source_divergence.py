import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankmatch.llm import source_divergence
from rankmatch.llm.source_divergence import Forest
from tests.llm.helpers import docs, edge_rows, empty, rows_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def slow(rows, min_docs, top):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    texts = [(g or "", s or "", TERM.findall(low(t or ""))) for _, t, g, s in rows]
    found = []
    for lang in {g for g, _, _ in texts}:
        own = [(s, ts) for g, s, ts in texts if g == lang]
        df = Counter(t for _, ts in own for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for s, ts in own:
            counts[s].update(t for t in ts if df[t] >= min_docs)
        total = sum(counts.values(), Counter())

        def p(c, n):
            return 1 + 1_000_000_000 * (c + 5) // (n + 5 * len(kept))

        sizes = {s: sum(c.values()) for s, c in counts.items()}
        for s in counts:
            parts = {
                "pair": [
                    (o, sum(abs(p(counts[s][t], sizes[s]) - p(counts[o][t], sizes[o])) for t in kept)) for o in counts if o != s
                ],
                "term": [
                    (t, p(counts[s][t], sizes[s]) - p(total[t], sum(sizes.values()))) for t in kept if counts[s][t]
                ],
            }
            for part, items in parts.items():
                items = sorted((x for x in items if part == "pair" or x[1] > 0), key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[: None if part == "pair" else top], 1):
                    found.append((lang, s, part, item, value, rank))
    return sorted(found, key=repr)


def corpus():
    rng = random.Random(41)
    rows = []
    for i in range(260):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice([f"s{k}" for k in range(9)] + ["hot"] * 9 + [None, "é"])
        words = [rng.choice(["The", "the", "été", "x1y", "straße", "IS", "q" + chr(97 + rng.randrange(26))]) for _ in range(rng.randint(0, 30))]
        rows.append((i, rng.choice([" ", ", ", "7"]).join(words), lang, source))
    return rows + [(900, None, "xx", "alone"), (901, "nothing kept here", "yy", "a"), (902, "", "yy", "b")]


def test_equal_subtrees_are_one_node_and_prices_are_exact():
    rng = np.random.default_rng(4)
    for terms in (1, 2, 5, 64, 100):
        counts = rng.integers(0, 3, (6, terms)) * rng.integers(0, 2, (6, terms))
        counts[1] = counts[0]
        counts[2, : terms // 2] = 0
        forest = Forest(counts)
        assert forest.roots[0] == forest.roots[1]
        prices = source_divergence.price_table(forest.values, [10, 11, 12, 13, 14, 15])
        a, b = np.nonzero(np.ones((6, 6), bool))
        leaf = np.searchsorted(forest.values, counts)
        want = [np.abs(prices[i, leaf[i]] - prices[j, leaf[j]]).sum() for i, j in zip(a, b)]
        assert forest.price(a, b, prices).tolist() == want
    # All leaves alike: one node on each level, except where leaves beyond the terms begin.
    assert [len(x) for x in Forest(np.ones((3, 64), np.int64)).left] == [1] * 6


def test_prices_of_huge_counts_are_exact():
    table = source_divergence.price_table(np.array([0, 10**12]), [3 * 10**12 + 25, 0])
    assert table.tolist() == [[1, 1 + 10**9 * (10**12 + 5) // (3 * 10**12 + 25)], [0, 0]]


@pytest.mark.parametrize("sizes", [(1024, 32), (4, 3)])
def test_divergence_equals_brute_force(spark, sizes):
    rows = corpus()
    table = docs(spark, rows).repartition(5)
    got = rows_of(source_divergence.divergence(table, 12, 7, block_terms=sizes[0], tile_sources=sizes[1]))
    assert got == slow(rows, 12, 7)


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows()
    assert rows_of(source_divergence.divergence(docs(spark, rows), 1, 50)) == slow(rows, 1, 50)
    assert rows_of(source_divergence.divergence(docs(spark, rows))) == slow(rows, 30, 50)
    assert source_divergence.divergence(empty(spark)).count() == 0
