"""Runs against a brute-force search over all periods, and the digests of the query."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelterlens.llm import periodic_runs as R

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(x, least=R.LEAST_LENGTH):
    """All (start, length, period), period by period."""
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, 4 * q):
                s = x[i:i + n]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, n, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def found(docs):
    off = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
    words = np.array([w for d in docs for w in d], np.uint64)
    start, length, period = R.find_runs(words, off)
    return [(a, n, q) for a, n, q in zip(start.tolist(), length.tolist(), period.tolist())], off


repeated = st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=25), st.integers(1, 9)).map(lambda p: p[0] * p[1])
texts = st.lists(repeated, max_size=5).map(lambda parts: [w for p in parts for w in p])


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=3))
def test_runs_equal_brute_force(docs):
    got, off = found(docs)
    want = [(int(off[d]) + a, n, q) for d, x in enumerate(docs) for a, n, q in brute_runs(x, least=1)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_nested_and_highly_periodic():
    """A long period whose own stretches are highly periodic, and periods at both ends of a scale."""
    for q in (3, 4, 7, 8, 15, 16, 31, 32, 63, 64):
        base = [1] * (q - 1) + [2]
        for copies in (4, 5):
            x = [9] + base * copies + [8]
            got, _ = found([x])
            assert (1, q * copies, q) in got and got == brute_runs(x, least=1)
    x = ([1, 2] * 12 + [3]) * 5 + ([1, 2] * 12 + [4]) * 4
    assert found([x])[0] == brute_runs(x, least=1)


ROWS = [(1, "a b " * 9 + "c"), (2, None), (3, ""), (4, " \t\n\x0b "), (5, "one"), (6, "x x x x x"), (7, "x x x x x x"),
        (8, "A a A a A a A a"), (9, "é ü " * 5 + "\U0001f600"), (10, "the cat sat\ton the\nmat " * 4), (None, "q " * 30),
        (11, " ".join(f"w{i}" for i in range(50))), (11, " ".join(f"w{i}" for i in range(50)))]
# ids of turned texts: crc32 divisible by ten
TURNED = [i for i in range(12, 400) if zlib.crc32(str(i).encode()) % 10 == 0]


def test_query_rows_equal_brute_force(spark):
    rows = ROWS + [(i, " ".join(f"w{k % 97}" for k in range(i * 3))) for i in TURNED]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' as words", "'y' as start", "1 as n_runs", "2 as period")
    got = [tuple(r) for r in R.run_digests(docs).collect()]
    assert sorted(got, key=str) == sorted((brute_row(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 10


def test_empty_table_and_spans(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert R.run_digests(empty).count() == 0
    docs = spark.createDataFrame([(1, "y  a b a b\na b a b z"), (2, None), (None, "k k k k k k")], "doc_id long, text string")
    assert sorted((tuple(r) for r in R.runs_of(docs).collect()), key=str) == sorted(
        [(1, 1, 8, 2, "a b a b\na b a b"), (None, 0, 6, 1, "k k k k k k")], key=str)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    small = [tuple(r) for r in docs.collect() if len(r.text or "") < 4000]
    want = {brute_row(*r) for r in small}
    ids = {r[0] for r in small}
    assert {tuple(r) for r in R.run_digests(docs).collect() if r.doc_id in ids} == want
