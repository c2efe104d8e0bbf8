"""N-gram Jaccard join against brute force."""
import random

import pytest

from shelterlens.llm import ngram_join as nj


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingles(t)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if b < a and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, families=12, words=400):
    """Families of mutated copies of all sizes, with a passage that many share."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(words)]
    passage = [rng.choice(vocab) for _ in range(30)]
    rows, n = [], 0
    for _ in range(families):
        text = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 30, 90, 200]))]
        for _ in range(rng.choice([1, 2, 4, 9])):
            t = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            if rng.random() < .3:
                t = t + passage
            rows.append((n, " ".join(t)))
            n += rng.choice([1, 1, 3])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, monkeypatch, seed):
    rows = corpus(seed)
    if seed == 2:   # small blocks and units: many blocks meet, clusters are verified block by block
        monkeypatch.setattr(nj, "BLOCK_SHINGLES", 300)
        monkeypatch.setattr(nj, "UNIT_ENTRIES", 200)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in nj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def brute_links(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    return {i: sum(i != j and bool(a & b) and 100 * len(a & b) >= 75 * len(a | b) for j, b in sets.items())
            for i, a in sets.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_brute_force(spark, monkeypatch, seed):
    rows = corpus(seed)
    if seed == 2:   # units of two blocks, some with one block empty
        monkeypatch.setattr(nj, "BLOCK_SHINGLES", 300)
        monkeypatch.setattr(nj, "UNIT_ENTRIES", 200)
    got = nj.jaccard_links(spark.createDataFrame(rows + rows[:5], "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows) + 5
    assert {r.doc_id: r.n_links for r in got} == brute_links(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = nj.jaccard_components(odd_docs).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == sum(i is not None for i, _ in rows)     # repeated rows stay rows
    assert want[3][1] == 1 and want[8][1] == 7 and want[4] == (0, 4)
    kept = nj.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    gone = {i for i, (_, c) in want.items() if c != i}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted((i or 0) for i, _ in rows if i not in gone)


def test_no_rows(no_docs):
    assert nj.jaccard_components(no_docs).count() == 0
    assert nj.keep_one(no_docs).count() == 0


def test_links_by_lists_equal_all_pairs():
    import numpy as np
    rng = np.random.default_rng(5)
    items = [np.unique(rng.integers(0, 60, rng.integers(3, 40))) for _ in range(40)]
    sizes = np.array([len(x) for x in items])
    found = nj._links(list(range(40)), sizes, items)
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        both = len(np.intersect1d(items[a], items[b]))
        assert 100 * both >= 75 * (sizes[a] + sizes[b] - both)
        root[find(a)] = find(b)
    for a in range(40):
        for b in range(a):
            both = len(np.intersect1d(items[a], items[b]))
            if 100 * both >= 75 * (sizes[a] + sizes[b] - both):
                assert find(a) == find(b)


def test_boundary_follows_the_cost():
    small = [(n, 1000) for n in range(3, 9)]
    assert nj.boundary(small) >= 8                                    # a few pairs each: enumerate
    assert nj.boundary([(400, 1000)]) == 0                            # large sets: lists
    assert nj.boundary([*small, (400, 1000)]) == 8                    # both: small ones only
    even = [(n, 100) for n in range(3, 600)]
    assert 8 < nj.boundary(even) < nj.boundary(even, list_cost=50)
    assert nj.boundary([]) == 0
