"""Periodic runs: stretches of words that repeat with a period, four times and more.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and
length >= max(6, 4q) that no neighbouring word extends keeping period q.

Method: string synchronising sets at dyadic scales. At scale t = 4, 8, 16, ... a place i is
selected if the hash of the t words at i or of those at i + t is the least of all t-word
windows in [i, i + t]; whether a place is selected depends on its context of 2t words alone,
so equal contexts are selected alike. In a run of period q, t <= q < 2t, some selected place
lies in its first t places, and the next selected place with an equal context is exactly q
further: equal contexts at a distance in [t, 2t) propose a period. Windows of period <= t/4
are left out of the selection (they would all tie); they lie in the highly periodic regions,
the runs of smaller period, which are found before: periods 1 to 3 by comparing the text with
itself shifted, larger ones at the smaller scales. Every proposal is extended word by word to
the maximal stretch, so a hash decides only where to look.

All documents of an Arrow batch are handled at once as one array of words; a scale keeps the
documents of at least 4t words. No shuffle: a document is looked at in one task.

Defined results: null and empty texts have no words and no runs (four nulls, the hash of the
empty string); repeated rows are all returned; a null doc_id stays null and its text is not
turned; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame

from shelterlens.llm import common as C

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
DIRECT = 3          # periods found by shifting the text; the scales begin at the next one
TEXT_BYTES = 2 << 20   # text that is searched at a time
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def find_runs(words: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all stretches with length >= 4 periods, by place in ``words``.

    ``words``: numbers that are equal for equal words, of several documents in a row;
    document d holds the places off[d] to off[d + 1]. Runs come sorted by start and period.
    """
    runs = _small_periods(words, off)
    scale = DIRECT + 1
    while True:
        long = np.flatnonzero(np.diff(off) >= LEAST_EXPONENT * scale)
        if not len(long):
            break
        runs += _at_scale(words, off, long, scale, runs)
        scale *= 2
    found = np.array(sorted(set(runs)), np.int64).reshape(-1, 3)
    order = np.lexsort((found[:, 2], found[:, 0]))
    return found[order, 0], found[order, 1], found[order, 2]


def _small_periods(words, off):
    """Maximal stretches of the periods 1 to DIRECT: the text compared with itself shifted."""
    out, n = [], len(words)
    for q in range(1, DIRECT + 1):
        if n <= q:
            break
        same = words[q:] == words[:-q]
        for s in range(1, q + 1):       # no pair reaches into the next document
            crossing = off[1:-1] - s
            same[crossing[(crossing >= 0) & (crossing < len(same))]] = False
        edge = np.diff(np.r_[False, same, False].astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q
        keep = stop - start >= LEAST_EXPONENT * q
        start, stop = start[keep], stop[keep]
        if q > 1:                       # all equal words: the period is 1
            varied = np.zeros(len(start), bool)
            for k in range(1, q):
                varied |= words[start + k] != words[start]
            start, stop = start[varied], stop[varied]
        out += [(a, b - a, q) for a, b in zip(start.tolist(), stop.tolist())]
    return out


def _window_hashes(words, width):
    """Hash of the ``width`` words from each place on (a power of two), by doubling; the last ones are cut."""
    h, step = C.mix(words ^ _MULT), 1
    while step < width:
        h = C.mix(h[:-step] * _MULT + h[step:])
        step *= 2
    return h


def _least(values, width):
    """Minimum of the ``width`` values from each place on (a power of two)."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def _at_scale(words, off, long, scale, runs):
    """Stretches of a period in [scale, 2 scale) in the documents ``long``."""
    lengths = np.diff(off)[long]
    base = np.r_[0, np.cumsum(lengths)]
    shift = np.repeat(off[long] - base[:-1], lengths)     # place in ``words`` less place here
    here = words[np.arange(base[-1]) + shift]
    h = _window_hashes(here, scale)
    # highly periodic windows: inside a stretch of a period of at most a quarter of the scale
    moved = dict(zip(long.tolist(), base[:-1].tolist()))
    deep = [(a, n) for a, n, q in runs if 4 * q <= scale and n >= scale]
    if deep:
        starts = np.array([a for a, _ in deep])
        owner = np.searchsorted(off, starts, "right") - 1
        mark = np.zeros(len(here) + 1, np.int64)
        for (a, n), d in zip(deep, owner.tolist()):
            if d in moved:
                x = a - int(off[d]) + moved[d]
                mark[x] += 1
                mark[x + n - scale + 1] -= 1
        h = np.where(np.cumsum(mark[:-1])[:len(h)] > 0, _FAR, h)
    # selected: the window at i or at i + scale is the least of those from i to i + scale
    reach = len(here) - 2 * scale + 1
    ends = np.minimum(h[:reach], h[scale:scale + reach])
    least = np.minimum(_least(h, scale)[:reach], h[scale:scale + reach])
    place = np.flatnonzero((ends == least) & (ends != _FAR))
    document = np.searchsorted(base, place, "right") - 1
    inside = place + 2 * scale <= base[document + 1]
    place, document = place[inside], document[inside]
    if len(place) < 2:
        return []
    context = _window_hashes(here, 2 * scale)[place]
    order = np.lexsort((place, context, document))
    place, context, document = place[order], context[order], document[order]
    gap = place[1:] - place[:-1]
    pair = (document[1:] == document[:-1]) & (context[1:] == context[:-1]) & (gap >= scale) & (gap < 2 * scale)
    at, period, document = place[:-1][pair], gap[pair], document[:-1][pair]
    order = np.lexsort((at, period, document))
    out, last = [], (-1, -1, -1)
    for x, q, d in zip(at[order].tolist(), period[order].tolist(), document[order].tolist()):
        if last[:2] == (d, q) and x + q < last[2]:
            continue                    # inside the stretch just found
        lo, hi = int(base[d]), int(base[d + 1])
        a, b = _extended(here, x, q, lo, hi)
        last = (d, q, b)
        if b - a >= LEAST_EXPONENT * q:
            out.append((a + int(shift[a]), b - a, q))
    return out


def _extended(words, at, period, lo, hi):
    """The maximal stretch of this period around ``at`` within [lo, hi), in growing steps."""
    b, step = at + period, 64
    while b < hi:
        stop = min(b + step, hi)
        other = np.flatnonzero(words[b:stop] != words[b - period:stop - period])
        if len(other):
            b += int(other[0])
            break
        b, step = stop, step * 2
    a, step = at, 64
    while a > lo:
        start = max(a - step, lo)
        other = np.flatnonzero(words[start:a] != words[start + period:a + period])
        if len(other):
            a = start + int(other[-1]) + 1
            break
        a, step = start, step * 2
    return a, b


# ---------------------------------------------------------------- documents
def turned(n: int, doc_id: int) -> np.ndarray | None:
    """Places that the words of a turned document come from; None where it stays as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % (1 + (n - a) // (3 + g % 8)), i)


def _best(runs):
    """The run of greatest exact length / period; ties to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run      # runs come by start, then period
    return best


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _describe(doc_id, runs, kept_text):
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    best = _best(runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept_text).hexdigest())


def _documents(ids, column):
    """One row per document of a piece of a batch."""
    buf, off = C.text_buffer(column)
    starts, ends, first = C.word_spans(buf, off)
    hashes = C.word_hashes(buf, starts, ends)
    turns = [None if doc is None else turned(int(n), doc) for doc, n in zip(ids, np.diff(first).tolist())]
    for d, places in enumerate(turns):
        if places is not None:
            hashes[first[d]:first[d + 1]] = hashes[first[d]:first[d + 1]][places]
    start, length, period = find_runs(hashes, first)
    long_enough = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    start, length, period = start[long_enough], length[long_enough], period[long_enough]
    cut = np.searchsorted(start, first)
    for d, doc in enumerate(ids):
        runs = list(zip((start[cut[d]:cut[d + 1]] - first[d]).tolist(), length[cut[d]:cut[d + 1]].tolist(),
                        period[cut[d]:cut[d + 1]].tolist()))
        words = buf[off[d]:off[d + 1]].tobytes().split()
        if turns[d] is not None:
            words = [words[i] for i in turns[d].tolist()]
        if runs:
            stay = np.ones(len(words), bool)
            for a, n, q in runs:
                stay[a + q:a + n] = False
            words = [words[i] for i in np.flatnonzero(stay).tolist()]
        yield _describe(doc, runs, b" ".join(words))


def _search(batches):
    import pyarrow as pa

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for batch in batches:
        ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
        sizes = np.diff(C.text_buffer(column)[1])
        piece = np.cumsum(sizes) // TEXT_BYTES
        rows = []
        for p in np.unique(piece):
            a, b = np.searchsorted(piece, [p, p + 1])
            rows += _documents(ids[a:b], column[a:b])
        columns = list(zip(*rows)) if rows else [()] * len(names)
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of documents (doc_id, text): number of runs, the run of greatest exponent, and digests
    of all runs and of the text without the repetitions."""
    return C.arrow_map(docs.select("doc_id", "text"), _search, SCHEMA)


def _spans(batches):
    import pyarrow as pa

    for batch in batches:
        ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
        buf, off = C.text_buffer(column)
        starts, ends, first = C.word_spans(buf, off)
        start, length, period = find_runs(C.word_hashes(buf, starts, ends), first)
        keep = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
        start, length, period = start[keep], length[keep], period[keep]
        owner = np.searchsorted(first, start, "right") - 1
        texts = [buf[starts[a]:ends[a + n - 1]].tobytes().decode() for a, n in zip(start.tolist(), length.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[d] for d in owner.tolist()], pa.int64()), pa.array(start - first[owner], pa.int64()),
             pa.array(length, pa.int64()), pa.array(period, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "start", "length", "period", "text"])


def runs_of(docs: DataFrame) -> DataFrame:
    """The runs of the texts as they are: (doc_id, start, length, period, text), one row per run."""
    return C.arrow_map(docs.select("doc_id", "text"), _spans,
                       "doc_id long, start long, length long, period long, text string")
