import random

import numpy as np
import pyarrow as pa

from rankmatch.llm import shingle_join
from rankmatch.llm.common import WordHashes
from rankmatch.llm.shingle_join import Scheme
from tests.llm.helpers import WORD, docs, edge_rows, empty
from tests.llm.test_simhash import slow_roots


def slow_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def linked(a, b):
    return 100 * len(a & b) >= 90 * len(a | b) > 0


def corpus(seed=31):
    rng = random.Random(seed)
    rows = []
    for _ in range(40):
        words = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 2, 5, 12, 30, 90, 300]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(["NEW", "x", "yy"])
            rows.append((5000 - len(rows), " ".join(copy), "en", "s"))
    # A chain: each text is close to the next one only.
    chain = [f"w{i}" for i in range(200)]
    for k in range(30):
        rows.append((9000 - k, " ".join(chain), "en", "s"))
        chain[6 * k] = f"z{k}"
    return rows


def expected(rows):
    sets = [slow_set(t) for _, t, _, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])]
    groups = {}
    for i, r in slow_roots(pairs, range(len(rows))).items():
        groups.setdefault(r, []).append(i)
    smallest = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        smallest |= {i: min(ids, default=None) for i in members}
    return sorted(((rows[i][0], len(sets[i]), smallest[i]) for i in range(len(rows))), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for scheme in (Scheme(), Scheme(90, 2, 5), Scheme(80, 1, 4), Scheme(90, 0, 1)):
        for n in (10, 11, 18, 19, 40, 200, 1500):
            for _ in range(6):
                a = np.unique(rng.integers(0, 1 << 63, n, np.int64).astype(np.uint64) * np.uint64(2))
                lost = int(rng.integers(0, len(a) * (100 - scheme.percent) // 100 + 1))
                b = rng.permutation(a)[: len(a) - lost]
                common = len(b)
                while 100 * common >= scheme.percent * (len(a) + len(b) + 1 - common):
                    b = np.append(b, np.uint64(rng.integers(0, 1 << 63)))
                both, counts = scheme.sign(np.concatenate([a, b]), np.array([len(a), len(b)]))
                one, two = both[: counts[0]].tolist(), both[counts[0] :].tolist()
                if scheme.far[scheme.band(np.array([max(len(a), len(b))]))[0]] or set(a.tolist()) == set(b.tolist()):
                    assert set(one) & set(two) or set(a.tolist()) == set(b.tolist())
                bits = shingle_join.parities(np.concatenate([a, b]), np.array([len(a), len(b)])).view(np.uint64)
                assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_bands_hold_all_similar_sizes():
    scheme = Scheme()
    for a in range(1, 3000):
        b = a * 100 // 90
        i, j = scheme.band(np.array([a, b]))
        assert j - i in (0, 1)
        # Sets of these sizes differ in at most k, and fewer than n1 * (k2 + 1).
        k = scheme.far[j]
        assert (a + b) // 19 <= k and (k == 0 or scheme.partitions[j] * 2 > k)


def test_pieces_of_a_long_text_change_nothing(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["Ab ", "c", " \n", "é", "longword "]) for _ in range(rng.randint(0, 900))) for _ in range(30)]
    texts += ["x" * 5000, "y" * 70 + " " + "z" * 900 + " end of it", "", None]
    values = pa.array([t or "" for t in texts])
    whole = shingle_join.text_sets(values, 3, WordHashes())
    assert [len(slow_set(t)) for t in texts] == whole[1].tolist()
    for size in (1, 16, 64):
        monkeypatch.setattr(shingle_join, "PIECE", size)
        again = shingle_join.text_sets(values, 3, WordHashes())
        assert np.array_equal(again[0], whole[0]) and np.array_equal(again[1], whole[1])


def test_components_equal_brute_force(spark):
    rows = corpus()
    assert got(shingle_join.near_duplicates(docs(spark, rows))) == expected(rows)


def test_small_tiles_and_other_likeness(spark, monkeypatch):
    rows = corpus(32)
    monkeypatch.setattr(shingle_join, "TILE", 3)
    assert got(shingle_join.near_duplicates(docs(spark, rows))) == expected(rows)


def test_a_third_of_all_rows_are_close_copies(spark):
    rng = random.Random(33)
    base = [f"word{i}" for i in range(120)]
    rows = []
    for i in range(240):
        words = list(base) if i % 2 else [f"r{rng.random()}" for _ in range(120)]
        if i % 4 == 1:
            words[rng.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(words), "en", "hot"))
    table = docs(spark, rows).repartition(7)
    assert got(shingle_join.near_duplicates(table)) == expected(rows)


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows()
    assert got(shingle_join.near_duplicates(docs(spark, rows))) == expected(rows)
    assert shingle_join.near_duplicates(empty(spark)).count() == 0
