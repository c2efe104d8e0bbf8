"""Phrase collocations against counting in Python, with and without a bound on the numbered words."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from shelterlens.llm import collocations as K

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10, top=2000):
    counts, totals = [None, Counter(), Counter(), Counter()], Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts[k].update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    candidates = [(p, a) for k in (2, 3) for p, a in counts[k].items() if a >= least]
    longer = Counter()
    for p, a in candidates:
        if len(p) == 4:
            for q in ((p[0], p[1], p[2]), (p[0], p[2], p[3])):
                longer[q] = max(longer[q], a)
    found = {}
    for p, a in candidates:
        if len(p) == 3 and p in longer and 100 * longer[p] >= 50 * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            left, right = counts[k][p[:1 + k]], counts[len(p) - 1 - k][(p[0], *p[1 + k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, n, phrase.decode(), -a, left, right, totals[lang], -score)
                  for lang, rows in found.items()
                  for n, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


def got(docs, **more):
    return sorted(tuple(r) for r in K.collocations(docs, **more).collect())


ODD = [(None, "New York City. " * 12 + "Hot DOG hot dog"), (None, None), ("en", ""), ("en", " \t\n ,.;"), ("und", "new york " * 9),
       ("fr", "été là\té " * 11), ("fr", "ÉTÉ là, là là là là là là là là là là là là"), ("x", "a b c\ra b c\x0ba b c\x0ca b c\n" * 5),
       ("", "q w " * 20)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", ". ", ", x y z. x y z"]) for _ in range(400)]
    return ODD + [(rng.choice(["en", "de", None]), t) for t in texts] + [("en", "tie one. " * 10), ("en", "one tie. " * 10)]


@pytest.mark.parametrize("ranked", [1 << 20, 60, 0])
def test_equals_brute_force(spark, rows, monkeypatch, ranked):
    monkeypatch.setattr(K, "RANKED", ranked)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'k' as key", "1 as n", "'w' as word", "3 as a")
    want = brute(rows)
    assert len(want) > 60 and len({r[0] for r in want}) >= 5
    assert got(docs) == want


def test_dense_tiles_and_top(spark, rows, monkeypatch):
    """Dense counters (forced on) and sparse tiles give the same counts; the report is cut at ``top``."""
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    monkeypatch.setattr(K, "DENSE_FILL", 0.0)
    assert got(docs, top=5, least=3) == brute(rows, least=3, top=5)


def test_empty(spark):
    assert got(spark.createDataFrame([], "lang string, text string")) == []


def test_long_text_and_exact_scores(spark):
    """One very long text; counts whose products pass 64 bits are scored exactly."""
    text = "alpha beta " * 60_000 + "gamma delta " * 12
    assert got(spark.createDataFrame([("en", text)], "lang string, text string")) == brute([("en", text)])
    big = spark.sql("select 3000000001L as a, 4000000007L as l, 5000000011L as r")
    assert big.select(K._score("a", "l", "r")).first()[0] == 1000000 * 3000000001**2 // (4000000007 * 5000000011)


def test_tiles_count_like_a_counter():
    rng = np.random.default_rng(2)
    left, right = rng.zipf(1.3, 50_000) % 5000, rng.zipf(1.3, 50_000) % 5000
    for dense in ([], [(0, 0), (1, 0), (2, 3)]):
        tiles = K._Tiles(dense)
        for a in range(0, len(left), 7000):
            tiles.add(left[a:a + 7000], right[a:a + 7000])
        tiles.count()
        seen = Counter()
        for code, count in [tiles.take(), *tiles.cells()]:
            assert (np.diff(code.astype(np.int64)) > 0).all()
            seen.update(dict(zip(zip((code >> np.uint64(20)).tolist(), (code & np.uint64((1 << 20) - 1)).tolist()), count.tolist())))
        assert seen == Counter(zip(left.tolist(), right.tolist()))


def test_numbers(spark):
    counted = spark.createDataFrame([(i, 10 + i // 3) for i in range(30)] + [(99, 3)], "key long, n long")
    every = K.ranks(counted, "key", "n", 10)
    assert every.complete and list(every.counts) == sorted(every.counts, reverse=True) and len(every.counts) == 30
    assert every.of(np.array([29, 99, 12345], np.uint64)).tolist()[1:] == [-1, -1]
    few = K.ranks(counted, "key", "n", 10, most=7)
    assert not few.complete and len(few.counts) <= 7 and set(few.by_rank.tolist()) <= set(range(20, 30))
