"""Best-fit packing: documents as token pieces into sequences of at most 4096 tokens.

Method: best-fit decreasing with a segment tree over remaining capacities. Pieces of one
length are interchangeable, so the exact global decreasing order needs only the number
of pieces per length - at most ``capacity`` numbers however many documents there are.
``plan`` runs best fit on these counts: bins of equal remaining capacity form intervals,
and the tree finds the tightest capacity that still fits in O(log capacity). Its result
is a list of runs "the pieces of length l with ranks a.. go q a bin from bin b, offset o".

The rest is distributed: tokens and checksums per document (``pieces``), a rank of every
piece within its length (dealt over hash buckets so that one common length is no single
group), and a search of each rank in the plan.

Defined results: null and empty texts are one piece holding the end id; equal rows take
places of their own; a null doc_id stays null.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 1_000_000 # words whose ids a worker remembers, some 25 bytes each
CACHE_PARTS = 50_000    # parts of words whose ids it remembers


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- tokens
# Punctuation, Latin-1 letters, punctuation: the vocabulary's splitter makes one piece of each
# part, and no normalisation but lower-casing touches them. All else goes through the full pipeline.
_MARKS = r"[!-&(-/:-@\[-`{-~]*"
_PLAIN = re.compile(f"({_MARKS})([A-Za-zÀ-ÖØ-öø-ÿ]+)({_MARKS})")


class WordIds:
    """Token ids of words, remembered for up to CACHE_WORDS words in flat arrays.

    White space separates tokens in this vocabulary, so a text's ids are those of its words. Words are
    known by their 64-bit hash.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.as_chars = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts: dict[str, bytes] = {"": b""}
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, np.uint64)      # sorted hashes of the known words
        self.start = np.empty(0, np.int64)      # where each one's ids lie in ``ids``
        self.count = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def part(self, text: str) -> bytes:
        got = self.parts.get(text)
        if got is None:
            if len(self.parts) >= CACHE_PARTS:
                self.parts = {"": b""}
            chars = text if text.isascii() else self.as_chars.pre_tokenize_str(text)[0][0]
            ids = [t.id for t in self.model.tokenize(chars)]
            got = self.parts[text] = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def tokenized(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (UTF-8) as little-endian bytes."""
        out: list[bytes] = [b""] * len(words)
        rest = []
        for i, w in enumerate(words):
            text = w.decode()
            m = None if "<|" in text else _PLAIN.fullmatch(text)    # its special tokens look like <|this|>
            if m is None:
                rest.append((i, text))
            else:
                a, b, c = m.groups()
                out[i] = self.part(a) + self.part(b.lower()) + self.part(c)
        for x in range(0, len(rest), 2000):
            some = rest[x:x + 2000]
            found = self.whole.encode_batch_fast([t for _, t in some], add_special_tokens=False)
            for (i, _), e in zip(some, found):
                out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return out

    def of(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        keys, first, where = np.unique(C.word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(keys, self.keys, assume_unique=True))
        if len(self.keys) + len(new) > CACHE_WORDS:
            self.forget()
            new = np.arange(len(keys))
        if len(new):
            raw = buf.tobytes()
            found = self.tokenized([raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            count = np.array([len(f) // 4 for f in found], np.int32)
            start = len(self.ids) + np.cumsum(count, dtype=np.int64) - count
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.start, self.count = np.insert(self.start, at, start), np.insert(self.count, at, count)
        known = np.searchsorted(self.keys, keys)[where]
        start, count = self.start[known], self.count[known].astype(np.int64)
        upto = np.cumsum(count)
        return self.ids[np.repeat(start - (upto - count), count) + np.arange(upto[-1] if len(upto) else 0)], count


_KNOWN: dict[str, WordIds] = {}   # of this worker process, by vocabulary file


def _cut(path: str, capacity: int):
    def run(batches):
        import pyarrow as pa

        if path not in _KNOWN:
            _KNOWN[path] = WordIds(path)
        known = _KNOWN[path]
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out = []
            docs, column = batch.column("doc_id").to_pylist(), batch.column("text")
            group = np.cumsum(np.diff(C.text_buffer(column)[1])) // C.CHUNK_BYTES
            for g in np.unique(group):
                a, b = np.searchsorted(group, [g, g + 1])
                buf, off = C.text_buffer(column[a:b])
                starts, ends, first = C.word_spans(buf, off)
                ids, count = known.of(buf, starts, ends)
                edge = np.r_[0, np.cumsum(count)][first].tolist()       # ids before each document
                for doc, x, y in zip(docs[a:b], edge[:-1], edge[1:]):
                    raw = ids[x:y].tobytes() + end
                    n = len(raw) // 4
                    for k, at in enumerate(range(0, n, capacity)):
                        piece = raw[4 * at:4 * (at + capacity)]
                        out.append((doc, k, at, len(piece) // 4, zlib.crc32(piece)))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut into pieces of at most ``capacity`` ids."""
    return C.arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _cut(path or tokenizer_path(), capacity),
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---------------------------------------------------------------- the plan
class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which of them have open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.any = [False] * (2 * self.leaves)

    def put(self, capacity: int, some: bool) -> None:
        i = capacity + self.leaves
        self.any[i] = some
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest remaining capacity of at least ``least`` that has an open bin."""
        i = least + self.leaves
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces: runs (length, first rank, first bin, offset, q).

    Within a run consecutive ranks fill bins one after another with q pieces each.
    """
    tree, open_bins, next_bin, runs = CapacityTree(capacity), {}, 0, []

    def keep(rest, first, bins):
        if bins and rest:
            open_bins.setdefault(rest, []).append((first, bins))
            tree.put(rest, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, next_bin
                bins = -(-left // (room // length))
                next_bin += bins
            else:
                first, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    tree.put(room, False)
            q = room // length
            used = min(bins, -(-left // q))
            placed = min(left, used * q)
            runs.append((length, rank, first, capacity - room, q))
            full, part = divmod(placed, q)
            keep(room - q * length, first, full)
            if part:
                keep(room - part * length, first + full, 1)
            keep(room, first + used, bins - used)
            rank += placed
            left -= placed
    return runs


# ---------------------------------------------------------------- the operator
def _place(shared):
    def run(batches):
        import pyarrow as pa

        length, rank, first, offset, q = shared.value
        key = (length << 44) + rank
        for batch in batches:
            le, ra = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, (le << 44) + ra, "right") - 1
            k = ra - rank[at]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(first[at] + k // q[at]),
                                                    pa.array(offset[at] + (k % q[at]) * le)],
                names=[*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Places of all pieces: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    spark = docs.sparkSession
    found = materialize(pieces(docs, path, capacity))
    counts = {r["length"]: r["c"] for r in found.groupBy("length").agg(F.count("*").alias("c")).collect()}
    runs = sorted(plan(counts, capacity)) or [(0, 0, 0, 0, 1)]
    shared = spark.sparkContext.broadcast(tuple(np.array(c, np.int64) for c in zip(*runs)))
    # rank within the length: hash buckets in order, rows of a bucket in order
    spread = 4 * C.parts_of(spark)
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(spread)))
    base = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("c"))
            .selectExpr("length", "bucket", "coalesce(sum(c) over (partition by length order by bucket "
                        "rows between unbounded preceding and 1 preceding), 0) as base"))
    ranked = dealt.selectExpr("*", "row_number() over (partition by length, bucket "
                              "order by doc_id, piece, start, ids_crc32) - 1 as r")
    ranked = ranked.join(base, ["length", "bucket"]).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "cast(r + base as bigint) as rank")
    return C.arrow_map(ranked, _place(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                               "sequence_id long, offset long")
