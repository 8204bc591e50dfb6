import random

import numpy as np
import xxhash

from rankmatch.llm import components, simhash
from tests.llm.helpers import WORD, docs, edge_rows, empty


def slow_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_roots(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_fingerprints():
    rng = random.Random(13)
    for _ in range(300):
        text = "".join(rng.choice(["A", "b ", "É", " ", "\n", "cd ", "\xa0"]) for _ in range(rng.randint(0, 40)))
        assert simhash.fingerprint(text.encode()) == slow_print(text)


def test_trees_find_all_within_the_radius():
    rng = random.Random(14)
    base = [rng.getrandbits(64) for _ in range(8)]
    prints = np.array(sorted({near(rng, b, rng.randint(0, 5)) for b in base for _ in range(40)}), np.uint64)
    tree = np.sort(np.array([rng.randint(0, 3) for _ in prints]))
    forest = simhash.Forest(prints, tree)
    got = {(int(a), int(b)) for x in forest.within(np.arange(len(prints)), 3) for a, b in zip(*x)}
    want = {
        (i, j)
        for i in range(len(prints))
        for j in range(len(prints))
        if i != j and tree[i] == tree[j] and int(prints[i] ^ prints[j]).bit_count() <= 3
    }
    assert got == want


def test_close_fingerprints_share_a_shard_at_every_size():
    rng = random.Random(15)
    for n in (10, 10**7, 10**9, 10**12):
        masks = simhash.shard_masks(n, 3)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = near(rng, a, rng.randint(0, 3))
            assert any(a & m == b & m for m in masks)


def test_links_equal_brute_force(spark, monkeypatch):
    rng = random.Random(16)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    prints = {near(rng, s, rng.randint(0, 4)) for s in seeds for _ in range(12)}
    chain = rng.getrandbits(64)
    for _ in range(40):
        chain = near(rng, chain, 3)
        prints.add(chain)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    unsigned = [p % (1 << 64) for p in signed]
    pairs = [
        (signed[i], signed[j])
        for i in range(len(signed))
        for j in range(i)
        if (unsigned[i] ^ unsigned[j]).bit_count() <= 3
    ]
    want = {n: r for n, r in slow_roots(pairs, signed).items() if n != r}
    table = spark.createDataFrame([(p,) for p in signed * 2], "fp long")
    for limit in (simhash.SLICE, 4):
        # With a small slice every shard is split over several tasks.
        monkeypatch.setattr(simhash, "SLICE", limit)
        assert {r.node: r.root for r in simhash.link(table).collect()} == want


def test_components(spark):
    rng = random.Random(17)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    pairs += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    nodes = {n for p in pairs for n in p}
    links = spark.createDataFrame(pairs + [(None, 3), (5, None)], "x long, y long")
    got = {r.node: r.root for r in components.components(links, "x", "y").collect()}
    assert got == {n: r for n, r in slow_roots(pairs, nodes).items() if n != r}


def corpus():
    rng = random.Random(18)
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(rng.randint(0, 200))]
        for k in range(rng.choice([1, 1, 2, 5])):
            copy = list(words)
            if k > 2 and copy:
                copy[rng.randrange(len(copy))] = "new"
            rows.append((1000 - len(rows), " ".join(copy), "en", "s"))
    return rows


def expected(rows):
    prints = [slow_print(t) for _, t, _, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = slow_roots(pairs, range(len(rows)))
    groups = {}
    for i, r in roots.items():
        groups.setdefault(r, []).append(rows[i][0])
    return prints, {i: groups[r] for i, r in roots.items()}


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    prints, groups = expected(rows)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, (doc_id, *_) in enumerate(rows):
        assert got[doc_id].fingerprint == format(prints[i], "016x")
        assert got[doc_id].component_id == min(groups[i])


def test_one_document_of_each_component_stays(spark):
    rows = corpus()
    _, groups = expected(rows)
    table = docs(spark, rows)
    kept = simhash.deduplicate(table)
    assert kept.schema == table.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted({min(g) for g in groups.values()})


def test_edge_rows_and_empty_table(spark):
    rows = edge_rows()
    table = docs(spark, rows)
    got = simhash.near_duplicates(table).collect()
    assert len(got) == len(rows)
    blank = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in blank} == {1, 2, 3, None} and {r.component_id for r in blank} == {1}
    kept = [r.doc_id for r in simhash.deduplicate(table).collect()]
    assert kept.count(4) == 1 and kept.count(1) == 1 and 2 not in kept
    nothing = [(None, None, None, None)] * 3
    assert simhash.deduplicate(docs(spark, nothing)).count() == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.deduplicate(empty(spark)).count() == 0
