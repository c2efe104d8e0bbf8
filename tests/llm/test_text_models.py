"""Substring dedup, lattice scoring and fingerprints against brute force."""
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelterlens.llm import fingerprints as fp
from shelterlens.llm import lm_score as lm
from shelterlens.llm import queries
from shelterlens.llm import substring_dedup as sd

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join("".join(rng.choice(["ka", "to", "ri", "é", "mun", "sel", "ow"]) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


# ---------------------------------------------------------------- substring dedup
def test_chunks_tile_texts_and_survive_insertions():
    rng = random.Random(3)
    texts = [prose(rng, 3000), "", "x", "a" * 20_000, "é" * 9000, None, "\U0001f600 z"]
    row, start, length, digest = sd.chunks(pa.array(texts))
    for i, t in enumerate(texts):
        raw, m = (t or "").encode(), row == i
        assert length[m].sum() == len(raw)
        for s, n in zip(start[m].tolist(), length[m].tolist()):
            raw[s:s + n].decode()           # never cut inside a character
            assert n <= sd.MAX_CHUNK
    a = set(digest[row == 0].tolist())
    shifted = texts[0][:500] + " inserted words " + texts[0][500:]
    _, _, _, again = sd.chunks(pa.array([shifted]))
    assert len(a & set(again.tolist())) > 0.97 * len(a)


@pytest.mark.parametrize("block", [None, 40])
def test_planted_passages_are_cut_and_clean_documents_stay(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(sd, "BLOCK_CHUNKS", block)
    rng = random.Random(11)
    passage, other = prose(rng, 55), prose(rng, 60)
    texts = {i: prose(rng, 120) for i in range(30)}
    for i in (4, 9, 17, 21):
        texts[i] = texts[i][:200] + " " + passage + " " + texts[i][200:]
    for i in (2, 9):
        texts[i] += "\n" + other
    texts[25] = texts[3]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    found = sd.repeats(df).collect()
    assert {r.doc_id for r in found} == {9, 17, 21, 25}
    assert {r.also_in for r in found} <= {2, 3, 4, 9, 17}
    out = {r.doc_id: r for r in sd.without_repeats(df).collect()}
    assert set(out) == set(texts) - {25}
    middle = passage[80:-80]
    assert [i for i, r in out.items() if middle in r.text] == [4]
    assert [i for i, r in out.items() if other[80:-80] in r.text] == [2]
    for i, r in out.items():
        assert r.n_chars == len(r.text)
        if i not in (9, 17, 21):
            assert r.text == texts[i]


def test_substring_dedup_of_odd_rows(spark, odd_docs, no_docs):
    out = sd.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    got = out.collect()
    assert sum(r.doc_id == 3 for r in got) == 0                 # rows 3 repeat document 1 as a whole
    assert sum(r.doc_id is None for r in got) == 1              # not looked at
    assert {4, 5, 6, 7, 9, 10, 11, 12} <= {r.doc_id for r in got}
    assert sd.repeats(no_docs).count() == 0 and sd.without_repeats(no_docs).count() == 0
    twice = odd_docs.filter("doc_id = 12").unionAll(odd_docs.filter("doc_id = 12"))
    assert sd.without_repeats(twice).count() == 2               # rows of one doc_id are one document


# ---------------------------------------------------------------- lattice
def test_lattice_sums_all_segmentations():
    pieces = {b"a": -1.0, b"b": -2.0, b"ab": -1.5, b"ba": -0.7, b"aba": -3.0}
    lat = lm.Lattice(pieces)
    for raw in (b"a", b"ab", b"abab", b"babaab"):
        total = 0.0
        for cut in itertools.product([0, 1], repeat=len(raw) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cut) if c], len(raw)]
            parts = [raw[x:y] for x, y in zip(at, at[1:])]
            if all(p in pieces for p in parts):
                total += math.exp(sum(pieces[p] for p in parts))
        assert math.isclose(lat.log_prob(raw), math.log(total), rel_tol=1e-12)
    assert lat.log_prob(b"c") is None


def expected_scores(rows):
    words = [((t or "").encode().lower().split(), zlib.crc32(str(i).encode()) % 10 == 0) for i, t in rows]
    c, ends = Counter(), 0
    for w, held in words:
        if not held:
            c.update(w)
            ends += 1
    total, kinds = sum(c.values()) + ends, len(c) + (ends > 0)
    norm = math.log10(total + 0.1 * (kinds + 1))
    enc, counts = lm.encoder(lm.vocabulary_path()), Counter()
    for w, n in c.items():
        for p in enc.encode_ordinary(" " + w.decode()):
            counts[p] += n
    pieces, end = lm.piece_scores(lm.vocabulary(lm.vocabulary_path()), counts, ends)
    assert math.isclose(sum(map(math.exp, pieces.values())) + math.exp(end), 1, rel_tol=1e-9)
    lat, seen, out = lm.Lattice(pieces), {}, []
    for (i, _), (w, held) in zip(rows, words):
        model = end + sum(seen[x] if x in seen else seen.setdefault(x, lat.log_prob(b" " + x)) for x in w)
        base = sum(math.log10(c[x] + 0.1) for x in w) + math.log10(ends + 0.1) - (len(w) + 1) * norm
        out.append((i, held, len(w) + 1, sum(x in c for x in w) + (ends > 0), total, base, model / math.log(10)))
    return out


def compare(got, rows):
    want = sorted(expected_scores(rows), key=lambda r: (str(r[0]), r[2]))
    got = sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_WORDS", 500)
    monkeypatch.setattr(lm, "BLOCK_PAIRS", 700)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    compare(queries.op5_lm_scoring(spark, SF).collect(), rows)


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    compare(lm.scores(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert lm.scores(no_docs).count() == 0


# ---------------------------------------------------------------- fingerprints
def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_estimate_jaccard():
    rng = random.Random(2)
    pairs = []
    for _ in range(150):
        w = prose(rng, rng.choice([30, 120, 600])).split()
        v = list(w)
        for _ in range(rng.choice([0, 2, 8, 40])):
            v[rng.randrange(len(v))] = "zz"
        pairs.append((" ".join(w), " ".join(v)))
    a, b = fp.of_texts([x for x, _ in pairs]), fp.of_texts([y for _, y in pairs])
    err = fp.likeness(a[1], b[1], a[2], b[2]) - np.array([jaccard(x, y) for x, y in pairs])
    assert abs(err.mean()) < 0.02 and err.std() < 0.06
    assert all((x == y) == (f == g) for (x, y), f, g in zip(pairs, a[0], b[0]) if shingles(x) == shingles(y))


def check_neighbours(got, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        m = len(t) // 4
        edited = t[:len(t) - m] + after[:m]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want


def test_neighbours_across_partitions(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_neighbours(queries.op8_document_fingerprints(spark, SF).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    got = fp.with_next(odd_docs).collect()
    check_neighbours(got, [(r.doc_id, r.text) for r in odd_docs.collect()])
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[5].fingerprint == by[6].fingerprint == fp.EMPTY and by[4].near_next == 1.0
    assert by[1].fingerprint == by[3].fingerprint != by[2].fingerprint and by[7].fingerprint == by[8].fingerprint
    assert fp.with_next(no_docs).count() == 0
    one = fp.with_next(odd_docs.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
