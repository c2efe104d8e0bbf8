"""Phrase collocations: phrases of two and three words that occur together more than their parts do.

Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces and those at spaces
and tabs into words; everything is counted per language (null: ``und``). A phrase's score is
floor(1000000 a a / (l r)) of its count a and those of the two parts of its lowest-scoring cut.

Method: direct-address tiling.

1. Words are counted (``vocabulary``); those that occur LEAST times or more are numbered from
   the most frequent on (``Ranks``). A phrase cannot occur more often than its words, so
   no other word can be in a candidate.
2. The numbers split the pairs into tiles of TILE x TILE. A task keeps a dense counter per tile
   where the frequencies lead to expect many hits (``dense_tiles``), filled by ``bincount`` of the
   place in the tile; all other tiles are sorted COO: sorted pair codes with their counts.
3. Tasks send sorted blocks of (pair code, count), one entry a pair and flush, dealt by ranges
   of codes, so that the counts of frequent words lie in many parts; parts add them up.
4. Frequent pairs are numbered anew, by their own frequency, and the same tiling of (pair, next
   word) counts the phrases of three words.
5. Joins of the counts give scores; phrases inside a longer one that makes up half of their
   occurrences go; the first TOP of each language stay.

The numbering is bounded by RANKED words (and pairs), which is what tasks get as a broadcast
table. Should more be frequent, the rest goes by its 64-bit hashes in sorted COO, exactly too.
Words and pairs are told apart by 64-bit hashes that include the language.

Defined results: null and empty texts have no words; repeated rows count each; other columns
are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

LEAST = 10               # occurrences of a candidate
TOP = 2000               # phrases reported per language
SALTS = 16               # shares of a language that are ranked side by side
RANKED = 1 << 20         # most words (and pairs) that are numbered; also the stride of a pair code
TILE_BITS = 10           # words on each side of a tile: 2 ** TILE_BITS
DENSE = 8                # most dense counters of a task (4 MB each)
DENSE_FILL = 1 / 16      # least expected hits a cell and flush of a dense tile
HELD = 1 << 21           # pairs that a task gathers before it counts them
FLUSH = 3 << 20          # counted entries that a task holds before it sends them
WORDS_HELD = 300_000     # distinct words that a task holds before it sends them
_BITS = 20
_STRIDE = np.uint64(_BITS)
_LOW = np.uint64((1 << _BITS) - 1)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_BREAK = _BLANK | _STOP


# ---------------------------------------------------------------- words
def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _pieces(batches):
    """(languages of the rows, lower-cased bytes, word starts, ends, row of each word) of pieces of the batches."""
    for batch in batches:
        langs = ["und" if v is None else v for v in batch.column("lang").to_pylist()]
        column = batch.column("text")
        sizes = np.diff(C.text_buffer(column)[1])
        piece = np.cumsum(sizes) // C.CHUNK_BYTES
        for p in np.unique(piece):
            a, b = np.searchsorted(piece, [p, p + 1])
            buf, off = C.text_buffer(column[a:b])
            buf = C.lowered(buf)
            starts, ends, first = C.word_spans(buf, off, _BREAK)
            yield langs[a:b], buf, starts, ends, np.repeat(np.arange(b - a), np.diff(first))


def _keys(langs, buf, starts, ends, row) -> np.ndarray:
    """64-bit hash of each word with its language."""
    seeds = np.array([_seed(v) for v in langs], np.uint64)
    return C.mix(C.word_hashes(buf, starts, ends) ^ seeds[row])


def _joined(buf, starts, ends, row) -> np.ndarray:
    """Whether each word and the next one lie in the same piece of the same text."""
    if len(starts) < 2:
        return np.zeros(0, bool)
    stops = np.cumsum(_STOP[buf])
    return (stops[ends[:-1] - 1] == stops[starts[1:]]) & (row[1:] == row[:-1])


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of keys."""
    return C.mix(left * np.uint64(0x9E3779B97F4A7C15) + C.mix(right))


def _count_words(batches):
    """(key, lang, word, n): distinct words of a task with their counts, sent in pieces."""
    import pyarrow as pa

    def merged(held):
        keys, counts, langs, words = (list(c) for c in zip(*held))
        key, first, where = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        count = np.bincount(where, np.concatenate(counts)).astype(np.int64)
        return key, count, pa.concat_arrays(langs).take(pa.array(first)), pa.concat_arrays(words).take(pa.array(first))

    def rows(held):
        key, count, lang, word = merged(held)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), lang, word, pa.array(count)],
                                          names=["key", "lang", "word", "n"])

    held, size = [], 0
    for langs, buf, starts, ends, row in _pieces(batches):
        if not len(starts):
            continue
        key, first, count = np.unique(_keys(langs, buf, starts, ends, row), return_index=True, return_counts=True)
        raw = buf.tobytes()
        word = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        held.append((key, count, pa.array([langs[r] for r in row[first].tolist()], pa.string()),
                     pa.array(word, pa.binary()).cast(pa.string())))
        size += len(key)
        if size > WORDS_HELD:
            held = [merged(held)]
            size = len(held[0][0])
            if size > WORDS_HELD // 2:
                yield rows(held)
                held, size = [], 0
    if held:
        yield rows(held)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(key, lang, word, n) of all words of documents (text, lang)."""
    counted = C.arrow_map(docs.select("lang", "text"), _count_words, "key long, lang string, word string, n long")
    return counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- numbers
@dataclass
class Ranks:
    """Keys numbered from the most frequent on; ``complete``: no other key occurs LEAST times."""
    by_rank: np.ndarray     # keys
    counts: np.ndarray      # their occurrences
    complete: bool

    def __post_init__(self):
        self.order = np.argsort(self.by_rank)
        self.sorted = self.by_rank[self.order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``, -1 for those without one."""
        if not len(self.sorted):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
        return np.where(self.sorted[at] == keys, self.order[at], -1)


def ranks(counted: DataFrame, key: str, count: str, least: int = LEAST, most: int | None = None) -> Ranks:
    """Numbers for the keys of ``counted`` that occur ``least`` times or more, at most ``most`` of them.

    A histogram of the counts (a row per eighth of a doubling) gives the count down to which all keys
    fit; only keys above it come to the driver.
    """
    most = min(RANKED if most is None else most, 1 << _BITS)
    frequent = counted.filter(F.col(count) >= least)
    step = F.floor(F.log2(F.col(count).cast("double")) * 8).cast("int")
    steps = sorted(((r[0], r[1]) for r in frequent.groupBy(step).count().collect()), reverse=True)
    down_to, total = None, 0
    for s, n in steps:
        total += n
        if total > most:
            break
        down_to = s
    complete = total <= most
    taken = frequent.filter(step >= (down_to if down_to is not None else 1 << 20)).select(key, count).toArrow()
    keys = taken.column(0).to_numpy().astype(np.int64).view(np.uint64)
    counts = taken.column(1).to_numpy().astype(np.int64)
    order = np.lexsort((keys, -counts))
    return Ranks(keys[order], counts[order], complete)


def dense_tiles(left: Ranks, right: Ranks) -> list[tuple[int, int]]:
    """Tiles with the most expected hits, if pairs were spread by the frequencies of their parts."""
    def mass(r):
        if not len(r.counts):
            return np.zeros(0)
        share = np.add.reduceat(r.counts, np.arange(0, len(r.counts), 1 << TILE_BITS)) / r.counts.sum()
        return share[:64]
    hits = np.outer(mass(left), mass(right)) * HELD
    best = np.argsort(-hits, axis=None, kind="stable")[:DENSE]
    return [divmod(int(x), hits.shape[1]) for x in best if hits.flat[x] >= DENSE_FILL * (1 << 2 * TILE_BITS)]


# ---------------------------------------------------------------- tiles
def _combined(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted COO: distinct codes and the sums of their counts."""
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.empty(0, np.int64)
    return code[first], np.add.reduceat(count, first) if len(first) else count


class _Tiles:
    """Counts of pairs of numbers that a task has met."""

    def __init__(self, dense):
        self.dense = {t: np.zeros(1 << 2 * TILE_BITS, np.int64) for t in dense}
        self.waiting, self.codes, self.counts, self.held, self.size = [], [], [], 0, 0

    def add(self, left, right):
        self.waiting.append((left.astype(np.uint64) << _STRIDE) | right.astype(np.uint64))
        self.held += len(left)
        if self.held >= HELD:
            self.count()

    def count(self):
        code = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint64)
        self.waiting, self.held = [], 0
        side, mask = np.uint64(TILE_BITS), np.uint64((1 << TILE_BITS) - 1)
        if self.dense and len(code):
            left, right = code >> _STRIDE, code & _LOW
            tile = ((left >> side) << side) | (right >> side)
            cell = ((left & mask) << side) | (right & mask)
            rest = np.ones(len(code), bool)
            for (a, b), counter in self.dense.items():
                here = tile == np.uint64(a << TILE_BITS | b)
                counter += np.bincount(cell[here].astype(np.int64), minlength=len(counter))
                rest &= ~here
            code = code[rest]
        if len(code):
            code.sort()
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            self.codes.append(code[first])
            self.counts.append(np.diff(np.r_[first, len(code)]))
            self.size += len(first)
            if self.size > FLUSH and len(self.codes) > 1:
                code, count = _combined(np.concatenate(self.codes), np.concatenate(self.counts))
                self.codes, self.counts, self.size = [code], [count], len(code)

    def take(self):
        """The sparse entries held, which are then forgotten."""
        if not self.codes:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        found = _combined(np.concatenate(self.codes), np.concatenate(self.counts))
        self.codes, self.counts, self.size = [], [], 0
        return found

    def cells(self):
        """Entries of the dense counters, tile by tile."""
        for (a, b), counter in self.dense.items():
            cell = np.flatnonzero(counter)
            left = (a << TILE_BITS) + (cell >> TILE_BITS)
            right = (b << TILE_BITS) + (cell & ((1 << TILE_BITS) - 1))
            code = (left.astype(np.uint64) << _STRIDE) | right.astype(np.uint64)
            yield code, counter[cell]


def _blocks(code, count, parts):
    """Entries as blocks for their parts: a part takes ranges of codes, 1/64 of the partners of one word each."""
    part = (C.mix(code >> np.uint64(_BITS - 6)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((code, part))
    code, count, part = code[order], count[order], part[order]
    edge = np.searchsorted(part, np.arange(parts + 1))
    return [(p, 0, C.pack(code[a:b], count[a:b].astype(np.int32)))
            for p, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if b > a]


def _tail_blocks(left, right, parts):
    """Pairs with a part that has no number, by their keys."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    count = np.diff(np.r_[first, len(left)])
    left, right = left[first], right[first]
    part = (pair_key(left, right) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    left, right, count, part = left[order], right[order], count[order], part[order]
    edge = np.searchsorted(part, np.arange(parts + 1))
    return [(p, 1, C.pack(left[a:b], right[a:b].view(np.int64), count[a:b].astype(np.int32)))
            for p, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if b > a]


def _tile(words, pairs, dense, parts):
    """Counts of (word, next word), or with numbered ``pairs`` of (pair, next word), as blocks."""
    def neighbours(piece):
        langs, buf, starts, ends, row = piece
        key, joined = _keys(langs, buf, starts, ends, row), _joined(buf, starts, ends, row)
        w = words.value
        if pairs is None:
            number = w.of(key)
            at = np.flatnonzero(joined)
            return key[at], key[at + 1], number[at], number[at + 1], w.complete
        p = pairs.value
        at = np.flatnonzero(joined)
        of_pair = pair_key(key[at], key[at + 1])
        number = p.of(of_pair)
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)     # pair and the pair one word on
        if p.complete:      # a frequent phrase holds two frequent pairs
            follows = follows[(number[follows] >= 0) & (number[follows + 1] >= 0)]
        third = key[at[follows] + 2]
        return of_pair[follows], third, number[follows], w.of(third), p.complete

    def run(batches):
        tiles, tail, waiting = _Tiles(dense), [], 0
        for piece in _pieces(batches):
            if len(piece[2]) < 2:
                continue
            left, right, a, b, complete = neighbours(piece)
            both = (a >= 0) & (b >= 0)
            tiles.add(a[both], b[both])
            if tiles.size > FLUSH:
                yield C.block_batch(_blocks(*tiles.take(), parts))
            if not complete:
                tail.append((left[~both], right[~both]))
                waiting += int((~both).sum())
                if waiting >= HELD:
                    yield C.block_batch(_tail_blocks(*(np.concatenate(c) for c in zip(*tail)), parts))
                    tail, waiting = [], 0
        tiles.count()
        code, count = tiles.take()
        if len(code):
            yield C.block_batch(_blocks(code, count, parts))
        for code, count in tiles.cells():
            if len(code):
                yield C.block_batch(_blocks(code, count, parts))
        if waiting:
            yield C.block_batch(_tail_blocks(*(np.concatenate(c) for c in zip(*tail)), parts))
    return run


def _add_up(words, pairs, least):
    """Sums of a part's blocks: (lk, rk, key, n) of the pairs that occur ``least`` times or more."""
    def rows(left, right, count):
        import pyarrow as pa

        keep = count >= least
        left, right, count = left[keep], right[keep], count[keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.view(np.int64)) for c in (left, right, pair_key(left, right), count.astype(np.int64))],
            names=["lk", "rk", "key", "n"])

    def finish(ranked, tail):
        if ranked:
            code, count = _combined(*(np.concatenate(c) for c in zip(*ranked)))
            first = words.value if pairs is None else pairs.value
            yield rows(first.by_rank[(code >> _STRIDE).astype(np.int64)], words.value.by_rank[(code & _LOW).astype(np.int64)], count)
        if tail:
            yield rows(*_combined_keys(tail))

    def run(batches):
        now, ranked, tail, size = None, [], [], 0
        for batch in batches:
            for part, kind, block in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(),
                                         batch.column("block")):
                if part != now:
                    yield from finish(ranked, tail)
                    now, ranked, tail, size = part, [], [], 0
                if kind == 0:
                    code, count = C.unpack(block.as_py(), np.uint64, np.int32)
                    ranked.append((code, count.astype(np.int64)))
                    size += len(code)
                else:
                    left, right, count = C.unpack(block.as_py(), np.uint64, np.int64, np.int32)
                    tail.append((left, right.view(np.uint64), count.astype(np.int64)))
                    size += len(left)
                if size > FLUSH:      # what a part holds grows with its distinct pairs, not with its blocks
                    ranked = [_combined(*(np.concatenate(c) for c in zip(*ranked)))] if ranked else []
                    tail = [_combined_keys(tail)] if tail else []
                    size = sum(len(e[0]) for e in ranked + tail) // 2
        yield from finish(ranked, tail)
    return run


def _combined_keys(entries):
    left, right, count = (np.concatenate(c) for c in zip(*entries))
    order = np.lexsort((right, left))
    left, right, count = left[order], right[order], count[order]
    first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    return left[first], right[first], np.add.reduceat(count, first)


def _counted(docs: DataFrame, words: Ranks, pairs: Ranks | None, least: int) -> DataFrame:
    """(lk, rk, key, n): frequent neighbours - keys of the left part, the right word, of both, and the count."""
    spark = docs.sparkSession
    C.ship(spark)
    parts = C.parts_of(spark)
    shared = spark.sparkContext.broadcast(words)        # at most RANKED keys each
    shared_pairs = None if pairs is None else spark.sparkContext.broadcast(pairs)
    dense = dense_tiles(words if pairs is None else pairs, words)
    buckets = parts * 4
    sent = C.arrow_map(docs.select("lang", "text"), _tile(shared, shared_pairs, dense, buckets), C.BLOCK_SCHEMA)
    return C.arrow_map(C.dealt(sent, parts), _add_up(shared, shared_pairs, least), "lk long, rk long, key long, n long")


# ---------------------------------------------------------------- scores
def _score(a, left, right):
    wide = [f"cast({c} as decimal(19, 0))" for c in (a, left, right)]
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * cast({wide[0]} * {wide[0]} as decimal(31, 0))) "
                  f"div ({wide[1]} * {wide[2]})").cast("long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language of documents (text, lang)."""
    all_words = materialize(vocabulary(docs))
    totals = all_words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = all_words.filter(F.col("n") >= least)
    words = ranks(all_words, "key", "n", least)
    pairs = materialize(_counted(docs, words, None, least))
    triples = materialize(_counted(docs, words, ranks(pairs, "key", "n", least), least))

    def word(name, *more):
        return frequent.select(F.col("key").alias(name), F.col("word").alias(f"word_{name}"),
                               F.col("n").alias(f"n_{name}"), *more)

    two = (pairs.select(F.col("lk").alias("k1"), F.col("rk").alias("k2"), F.col("n").alias("a"))
           .join(word("k1", "lang"), "k1").join(word("k2"), "k2"))
    three = (triples.select(F.col("lk").alias("pair"), F.col("rk").alias("k3"), F.col("n").alias("a"))
             .join(pairs.select(F.col("key").alias("pair"), F.col("lk").alias("k1"), F.col("rk").alias("k2"),
                                F.col("n").alias("n12")), "pair")
             .join(pairs.select(F.col("lk").alias("k2"), F.col("rk").alias("k3"), F.col("n").alias("n23")), ["k2", "k3"])
             .join(word("k1", "lang"), "k1").join(word("k2"), "k2").join(word("k3"), "k3"))
    three = materialize(three.select(
        "lang", "k1", "k2", "k3", F.concat_ws(" ", "word_k1", "word_k2", "word_k3").alias("phrase"), "a",
        F.col("n_k1").alias("l1"), F.col("n23").alias("r1"), F.col("n12").alias("l2"), F.col("n_k3").alias("r2")))
    inside = three.select("k1", "k2", "a").union(three.select("k2", "k3", "a")).toDF("k1", "k2", "a")
    inside = inside.groupBy("k1", "k2").agg(F.max("a").alias("longer"))
    two = (two.join(inside, ["k1", "k2"], "left").filter("longer is null or 100 * longer < 50 * a")
           .select("lang", F.concat_ws(" ", "word_k1", "word_k2").alias("phrase"), "a", F.col("n_k1").alias("l"),
                   F.col("n_k2").alias("r"), _score("a", "n_k1", "n_k2").alias("score")))
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    second = F.col("s2") < F.col("s1")
    three = three.select("lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                         F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # the first ones of each of SALTS shares of a language, and of those the first ones of the language: the last
    # step sees at most SALTS * top rows of one
    best = two.union(three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
