"""Mixing, packing and the pipeline against plain Python."""
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from shelterlens.llm import common as C
from shelterlens.llm import mixing, packing, quality_rules, queries
from shelterlens.session import materialize

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- mixing
def raked(cells, exponents):
    w = cells["tokens"] / cells["tokens"].sum()
    shares = {}
    for d, e in exponents.items():
        m = cells.groupby(f"_{d}")["tokens"].sum() ** e
        shares[d] = m / m.sum()
    for _ in range(500):
        for d in exponents:
            w = w * cells[f"_{d}"].map(shares[d]) / cells[f"_{d}"].map(w.groupby(cells[f"_{d}"]).sum())
    return w


def capped(cells, w, budget):
    ratio, lo, hi = w / cells["tokens"], 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (np.minimum(1, mid * ratio) * cells["tokens"]).sum() < budget else (lo, mid)
    return np.minimum(1, hi * ratio)


def test_probabilities_equal_plain_raking(spark):
    df = mixing.sampled(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    cells = df.groupby(["_source", "_lang", "_topic"]).agg(tokens=("n_tokens", "sum"), p=("probability", "first")).reset_index()
    cells = cells[cells.tokens > 0].reset_index(drop=True)
    w = raked(cells, mixing.EXPONENTS)
    assert np.abs(capped(cells, w, mixing.KEEP_SHARE * cells.tokens.sum()) - cells.p).max() < 1e-4
    kept = df[df.kept].n_tokens.sum() / df.n_tokens.sum()
    assert abs(kept - mixing.KEEP_SHARE) < 0.08


def test_hot_source_given_targets_and_odd_rows(spark, odd_docs, no_docs):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(100, 900)), rng.choice(["en", "de"]), "hot" if i % 3 else f"s{i % 7}")
            for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    levels = {"source": {"hot": 1.0, **{f"s{k}": 1.0 for k in range(7)}}, "lang": {"en": 3.0, "de": 1.0}}
    got = mixing.sampled(df, levels, keep_share=0.2).toPandas()
    expect = got.probability * got.n_tokens
    by = expect.groupby(got._source).sum() / expect.sum()
    assert np.allclose(by, 1 / 8, atol=2e-3)
    assert abs(expect[got._lang == "en"].sum() / expect.sum() - 0.75) < 2e-3
    again = mixing.sampled(df.repartition(5), levels, keep_share=0.2).filter("kept").select("doc_id").collect()
    assert sorted(r[0] for r in again) == sorted(got[got.kept].doc_id)
    out = mixing.keep_mixed(odd_docs)
    assert out.columns == odd_docs.columns and {5, 6} <= {r.doc_id for r in out.collect()}   # cells without tokens
    assert mixing.sampled(no_docs).count() == 0


def test_mixing_is_native(spark):
    plan = queries.op9_mixing_to_target_weights(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- packing
def plain_best_fit(lengths, capacity):
    import bisect
    free, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, n)
        if k < len(free):
            rest = free.pop(k) - n
        else:
            bins, rest = bins + 1, capacity - n
        if rest:
            bisect.insort(free, rest)
    return bins


def test_capacity_tree():
    rng, tree, held = random.Random(1), packing.CapacityTree(100), set()
    for _ in range(3000):
        c = rng.randrange(101)
        if rng.random() < .5:
            held.add(c)
        else:
            held.discard(c)
        tree.put(c, c in held)
        n = rng.randrange(101)
        assert tree.tightest(n) == min((x for x in held if x >= n), default=None)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(7)
    for capacity in (10, 64, 4096):
        for _ in range(15):
            lengths = [rng.randint(1, capacity) if rng.random() < .6 else rng.randint(1, 1 + capacity // 9)
                       for _ in range(rng.randint(1, 400))]
            counts = {n: lengths.count(n) for n in set(lengths)}
            bins, ranks = defaultdict(list), defaultdict(list)
            runs = packing.plan(counts, capacity)
            for k, (n, rank, first, offset, q) in enumerate(runs):
                later = [r[1] for r in runs[k + 1:] if r[0] == n]
                for j in range(min(later, default=counts[n]) - rank):
                    bins[first + j // q].append((offset + (j % q) * n, n))
                    ranks[n].append(rank + j)
            assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
            for held in bins.values():
                at = 0
                for offset, n in sorted(held):
                    assert offset == at
                    at += n
                assert at <= capacity
            assert len(bins) == plain_best_fit(lengths, capacity)


def check_packed(got, rows, capacity=4096):
    from tokenizers import Tokenizer
    tok, want = Tokenizer.from_file(packing.tokenizer_path()), []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a:a + capacity], "<u4")
            want.append((i, k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) == plain_best_fit([w[3] for w in want], capacity)


def test_packing_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packed(queries.op10_best_fit_packing(spark, SF).collect(), rows)


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    check_packed(packing.pack(odd_docs).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert packing.pack(no_docs).count() == 0


def test_word_ids_equal_whole_text_ids(monkeypatch):
    known = packing.WordIds(packing.tokenizer_path())
    text = ("The naïve (Ünï) --a-- don't x1y <|endoftext|> abc<|endoftext|> Σας STRASSE! straße a_b İ  nb ÿ. ×a 12,5 "
            "été \U0001f600ok ...!? #tag$")
    for limit in (packing.CACHE_WORDS, 3):
        monkeypatch.setattr(packing, "CACHE_WORDS", limit)
        words = text.encode().split()
        buf, off = C.text_buffer(pa.array([text]))
        starts, ends, _ = C.word_spans(buf, off)
        ids, count = known.of(buf, starts, ends)
        assert len(count) == len(words) and ids.tolist() == known.whole.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialize(stage(spark, docs, SF))
        if k < 4:
            assert tuple(out.columns) == corpus_pipeline.COLUMNS
            assert 0 < out.count() <= docs.count()
        if k == 0:
            kept = quality_rules.judged(docs).filter("kept").select("doc_id")
            assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in kept.collect())
        last, docs = docs, out
    check_packed(docs.collect(), [(r.doc_id, r.text) for r in last.collect()])
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
