"""Subword lattice likelihood: log10 probability of a text over all its segmentations.

The pieces are an existing byte-level vocabulary; their unigram scores come from the
training documents: every training word is segmented by the vocabulary's own tokenizer
and the pieces are counted (add-0.1 smoothing over all pieces and the end). A text's
probability is the sum over all ways to write it as pieces, by forward recursion in log
space. No piece has a space but at its start, so the lattice of a text falls apart at
its words and each distinct word is scored once; the text's score is the sum over its
words, and the end.

Beside it the base score: smoothed word unigrams. Both are sums over distinct words, so

1. ``word_counts``: distinct words with their training counts, by hash range;
2. piece counts: at most one row per piece of the vocabulary comes to the driver;
3. word occurrences of documents meet the scores of their words in the hash ranges, each
   range adds up its part of a document's scores, and the parts are summed by document.

Documents are combined in blocks first: a word that every document has is one entry per
document it is in, spread over no more than its hash range, and never a row per token.

Defined results: a null or empty text has only the end; repeated rows are scored each;
the doc_id (null: "None") decides what is held out: crc32 of its text mod 10 = 0.
"""

from __future__ import annotations

import base64
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

SMOOTH = 0.1
HELD_OUT_MOD = 10
SUB_BUCKETS = 4
BLOCK_WORDS = 400_000       # distinct words of a block before they are shuffled
BLOCK_PAIRS = 1_500_000     # (document, word) pairs of a block


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(path),
                             special_tokens={})


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_MOD == 0


# ---------------------------------------------------------------- lattice
class Lattice:
    """Marginal log probability (natural) of a byte string over all segmentations into pieces."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)

    def log_prob(self, raw: bytes) -> float:
        get, longest, log, exp = self.pieces.get, self.longest, math.log, math.exp
        alpha = [0.0]
        for i in range(1, len(raw) + 1):
            ways = []
            for j in range(max(0, i - longest), i):
                p = get(raw[j:i])
                if p is not None and alpha[j] is not None:
                    ways.append(alpha[j] + p)
            if len(ways) == 1:
                alpha.append(ways[0])
            elif ways:
                m = max(ways)
                alpha.append(m + log(sum([exp(w - m) for w in ways])))
            else:
                alpha.append(None)
        return alpha[-1]


# ---------------------------------------------------------------- 1 words
def _pack_words(h, count, words) -> bytes:
    size = np.array([len(w) for w in words], np.int32)
    head = C.pack(h, count, size)
    return np.int64(len(head)).tobytes() + head + b"".join(words)


def _unpack_words(raw: bytes):
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    h, count, size = C.unpack(raw[8:8 + n], np.uint64, np.int64, np.int32)
    off = np.r_[0, np.cumsum(size.astype(np.int64))] + 8 + n
    return h, count, [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def _merge_words(parts):
    """Sorted distinct hashes, summed counts and one spelling each of (h, count, words) parts."""
    h, count = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    words = [w for p in parts for w in p[2]]
    u, first, inv = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(inv, weights=count, minlength=len(u)).astype(np.int64)
    return u, total, [words[i] for i in first.tolist()]


def _texts(batch):
    """Pieces of a batch: (column slice, first row), small enough for their word arrays."""
    for a in range(0, batch.num_rows, 500):
        yield batch.column("text")[a:a + 500], a


def _words_of(column):
    buf, off = C.text_buffer(column)
    buf = C.lowered(buf)
    starts, ends, first = C.word_spans(buf, off)
    return buf, starts, ends, first, C.word_hashes(buf, starts, ends)


def _count(buckets: int):
    def flush(parts):
        h, count, words = _merge_words(parts)
        edge = C.bucket_bounds(h, buckets)
        return C.block_batch([(b, 0, _pack_words(h[x:y], count[x:y], words[x:y]))
                              for b, (x, y) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if y > x])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            train = np.array([not held_out(d) for d in batch.column("doc_id").to_pylist()], np.int64)
            for column, a in _texts(batch):
                buf, starts, ends, first, h = _words_of(column)
                weight = np.repeat(train[a:a + len(column)], np.diff(first))
                u, at, inv = np.unique(h, return_index=True, return_inverse=True)
                raw = buf.tobytes()
                parts.append((u, np.bincount(inv, weights=weight, minlength=len(u)).astype(np.int64),
                              [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]))
                size += len(u)
                if size >= BLOCK_WORDS:
                    parts = [_merge_words(parts)]
                    size = len(parts[0][0])
                    if size >= BLOCK_WORDS // 2:
                        yield flush(parts)
                        parts, size = [], 0
        if size:
            yield flush(parts)
    return run


def _sum_words(batches):
    for part, blocks in C.runs(batches):
        yield C.block_batch([(part, 0, _pack_words(*_merge_words([_unpack_words(b) for _, b in blocks])))])


def word_counts(docs: DataFrame, buckets: int, parts: int) -> DataFrame:
    """Blocks (part, kind, block) of distinct words and their counts in training documents."""
    return C.arrow_map(C.dealt(C.arrow_map(docs.select("doc_id", "text"), _count(buckets), C.BLOCK_SCHEMA), parts),
                       _sum_words, C.BLOCK_SCHEMA)


# ---------------------------------------------------------------- 2 pieces
def _piece_counts(path: str):
    """(piece, n) over the training words of a task; piece -1: words, -2: word tokens."""
    def run(batches):
        import pyarrow as pa

        enc, total, words, tokens = encoder(path), np.zeros(0, np.int64), 0, 0
        for batch in batches:
            for raw in batch.column("block"):
                _, count, spelled = _unpack_words(raw.as_py())
                known = [(w, c) for w, c in zip(spelled, count.tolist()) if c]
                words += len(known)
                tokens += sum(c for _, c in known)
                for a in range(0, len(known), 5000):
                    some = known[a:a + 5000]
                    ids = [enc.encode_ordinary(" " + w.decode()) for w, _ in some]
                    flat = np.concatenate([np.array(i, np.int64) for i in ids])
                    weight = np.repeat([c for _, c in some], [len(i) for i in ids])
                    now = np.bincount(flat, weights=weight)
                    if len(now) > len(total):
                        total = np.r_[total, np.zeros(len(now) - len(total))]
                    total[:len(now)] += now
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[at, -1, -2], pa.int64()), pa.array(np.r_[total[at], words, tokens].astype(np.int64))],
            names=["piece", "n"])
    return run


def piece_scores(vocab: dict[bytes, int], counts: dict[int, int], ends: int) -> tuple[dict[bytes, float], float]:
    """Natural log probability of each piece and of the end."""
    total = sum(counts.values()) + ends + SMOOTH * (len(vocab) + 1)
    return ({p: math.log((counts.get(i, 0) + SMOOTH) / total) for p, i in vocab.items()},
            math.log((ends + SMOOTH) / total))


# ---------------------------------------------------------------- 3 documents
def _occurrences(buckets: int, doc_parts: int):
    def flush(held, heads):
        h, doc, tf = (np.concatenate(c) for c in zip(*held)) if held else (np.empty(0, np.uint64),) * 3
        rows = []
        if len(h):
            o = np.argsort(h, kind="stable")
            h, doc, tf = h[o], doc[o], tf[o]
            edge = C.bucket_bounds(h, buckets)
            rows = [(b, 1, C.pack(h[x:y], doc[x:y], tf[x:y]))
                    for b, (x, y) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if y > x]
        uid, ids, null, n = (np.concatenate(c) for c in zip(*heads))
        part = C.id_bucket(uid, doc_parts)
        for p in np.unique(part):
            m = part == p
            rows.append((buckets + int(p), 2, C.pack(uid[m], ids[m], null[m], n[m])))
        return C.block_batch(rows)

    def run(batches):
        held, heads, size = [], [], 0
        for batch in batches:
            uid = batch.column("uid").to_numpy()
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for column, a in _texts(batch):
                _, starts, _, first, h = _words_of(column)
                n = np.diff(first)
                row = np.repeat(np.arange(len(n)), n)
                o = np.lexsort((h, row))
                h, row = h[o], row[o]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                s = slice(a, a + len(n))
                heads.append((uid[s], ids[s], null[s].astype(np.int8), n.astype(np.int64)))
                held.append((h[at], uid[s][row[at]], np.diff(np.r_[at, len(h)]).astype(np.int32)))
                size += len(at)
                if size >= BLOCK_PAIRS:
                    yield flush(held, heads)
                    held, heads, size = [], [], 0
        if heads:
            yield flush(held, heads)
    return run


def _score(buckets: int, doc_parts: int, shared):
    """Hash ranges: each word's scores times its occurrences, summed by document."""
    def sums(held):
        doc, known, base, model = (np.concatenate(c) for c in zip(*held))
        u, inv = np.unique(doc, return_inverse=True)
        cols = [np.bincount(inv, weights=c, minlength=len(u)) for c in (known, base, model)]
        return u, cols[0], cols[1], cols[2]

    def out(held):
        doc, known, base, model = sums(held)
        part = C.id_bucket(doc, doc_parts)
        o = np.argsort(part, kind="stable")
        edge = np.searchsorted(part[o], np.arange(doc_parts + 1))
        return C.block_batch([(buckets + p, 3, C.pack(doc[o[a:b]], known[o[a:b]].astype(np.int64), base[o[a:b]],
                                                      model[o[a:b]]))
                              for p, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if b > a])

    def run(batches):
        lattice, held, size = None, [], 0
        for part, blocks in C.runs(batches):
            if part >= buckets:
                yield C.block_batch([(part, k, b) for k, b in blocks])
                continue
            lattice = lattice or Lattice(shared.value)
            word, count, spelled = _merge_words([_unpack_words(b) for k, b in blocks if k == 0])
            model = np.array([lattice.log_prob(b" " + w) for w in spelled]) / math.log(10)
            base = np.log10(count + SMOOTH)
            for k, b in blocks:
                if k == 1:
                    h, doc, tf = C.unpack(b, np.uint64, np.int64, np.int32)
                    at = np.searchsorted(word, h)
                    held.append((doc, tf * (count[at] > 0), tf * base[at], tf * model[at]))
                    size += len(doc)
            if size > 1_000_000:
                held = [sums(held)]
                size = len(held[0][0])
                if size > 500_000:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)
    return run


def _total(batches):
    import pyarrow as pa

    for _, blocks in C.runs(batches):
        heads = [C.unpack(b, np.int64, np.int64, np.int8, np.int64) for k, b in blocks if k == 2]
        some = [C.unpack(b, np.int64, np.int64, np.float64, np.float64) for k, b in blocks if k == 3]
        uid, ids, null, n = (np.concatenate(c) for c in zip(*heads))
        o = np.argsort(uid)
        uid, ids, null, n = uid[o], ids[o], null[o], n[o]
        cols = [np.zeros(len(uid))] * 3
        if some:
            doc, *cols = (np.concatenate(c) for c in zip(*some))
            at = np.searchsorted(uid, doc)
            # in order of size: the sum does not depend on which part came first
            cols = [np.bincount(at[q], weights=c[q], minlength=len(uid))
                    for c, q in ((c, np.lexsort((c, at))) for c in cols)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(n), pa.array(cols[0].astype(np.int64)),
             pa.array(cols[1]), pa.array(cols[2])], names=["doc_id", "words", "known", "base", "model"])


def scores(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of documents (doc_id, text)."""
    spark, path = docs.sparkSession, path or vocabulary_path()
    parts = C.parts_of(spark)
    buckets = parts * SUB_BUCKETS
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    words = materialize(word_counts(docs, buckets, parts))
    counts = {r["piece"]: r["n"] for r in C.arrow_map(words, _piece_counts(path), "piece long, n long")
              .groupBy("piece").agg(F.sum("n").alias("n")).collect()}   # at most the vocabulary's size
    is_held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")).cast("binary")),
                     F.lit(HELD_OUT_MOD)) == 0
    ends = docs.select("doc_id").filter(~is_held).count()
    distinct, tokens = counts.pop(-1, 0) + (ends > 0), counts.pop(-2, 0) + ends
    pieces, end = piece_scores(vocabulary(path), counts, ends)
    shared = spark.sparkContext.broadcast(pieces)
    posted = C.arrow_map(docs.withColumn("uid", F.monotonically_increasing_id()),
                         _occurrences(buckets, parts), C.BLOCK_SCHEMA)
    summed = C.arrow_map(C.dealt(posted.union(words), parts), _score(buckets, parts, shared), C.BLOCK_SCHEMA)
    per = C.arrow_map(C.dealt(summed, parts), _total, "doc_id long, words long, known long, base double, model double")
    norm = math.log10(tokens + SMOOTH * (distinct + 1))
    return per.select(
        "doc_id", is_held.alias("held_out"), (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + SMOOTH) - (F.col("words") + 1) * norm).alias("base_score"),
        (F.col("model") + end / math.log(10)).alias("score"))
