"""Document fingerprints: one-permutation MinHash with optimal densification, b-bit packed.

Each 5-word shingle hash falls into one of ``BINS`` bins, which keeps its smallest value:
every shingle is hashed once. An empty bin copies a non-empty one that a 2-universal hash
of (bin, attempt) chooses, attempt after attempt (optimal densification), so that two
sets copy alike. Of every bin value the low ``BITS`` bits are stored. Two fingerprints
agree in a bin by chance with probability 2^-BITS; ``likeness`` corrects for that:
(agreement - 2^-BITS) / (1 - 2^-BITS), cut to [0, 1].

``with_next`` pairs each document with the next by doc_id without a global window:
range-partitioned sort, then only the first and last document of each partition cross
a partition border.

Defined results: null and empty texts have the fingerprint ``EMPTY`` (likeness 1 to each
other, 0 to all else); rows of equal doc_id follow each other in order of text; rows with
a null doc_id come first; a single document is its own next.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

BINS = 256
BITS = 4
EMPTY = ""
ATTEMPTS = 4096


def _choices() -> np.ndarray:
    """Bin chosen for (bin, attempt): a 2-universal hash, the same for all documents."""
    k = np.arange(BINS, dtype=np.uint64)[:, None] * np.uint64(ATTEMPTS) + np.arange(ATTEMPTS, dtype=np.uint64)
    return (C.mix(k + np.uint64(0x51ED270B))  % np.uint64(BINS)).astype(np.int16)


_CHOICES: list[np.ndarray] = []


def bin_values(hashes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, BINS) bin minima after densification; rows without hashes are all ones."""
    if not _CHOICES:
        _CHOICES.append(_choices())
    choice, rows = _CHOICES[0], len(off) - 1
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    v = np.full((rows, BINS), none, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(off))
    # sets are sorted within a row and the bin is the top of the hash: its first value is the least
    cell = row * BINS + (hashes >> np.uint64(64 - 8)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    v.reshape(-1)[cell[first]] = C.mix(hashes[first])
    filled = v != none
    r, b = np.nonzero(~filled & filled.any(axis=1)[:, None])
    out = v.copy()
    for t in range(ATTEMPTS):
        if not len(r):
            break
        c = choice[b, t]
        ok = filled[r, c]
        out[r[ok], b[ok]] = v[r[ok], c[ok]]
        r, b = r[~ok], b[~ok]
    if len(r):  # no choice met a filled bin: the first filled one after it
        for i, j in zip(r.tolist(), b.tolist()):
            k = np.flatnonzero(filled[i])
            out[i, j] = v[i, k[np.searchsorted(k, j) % len(k)]]
    return out


def packed(values: np.ndarray, empty: np.ndarray) -> list[str]:
    """Low bits of each bin, two bins a byte, as hex."""
    low = (values & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    raw = low[:, 0::2] << BITS | low[:, 1::2]
    return [EMPTY if e else x.tobytes().hex() for e, x in zip(empty, raw)]


def of_texts(texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Fingerprints, low bits and emptiness of a list of texts."""
    import pyarrow as pa

    fps, lows, empties = [], [], []
    for a in range(0, len(texts), 500):
        h, off = C.shingle_sets(pa.array(texts[a:a + 500], pa.large_string()))
        empty = np.diff(off) == 0
        v = bin_values(h, off)
        fps += packed(v, empty)
        lows.append((v & np.uint64((1 << BITS) - 1)).astype(np.uint8))
        empties.append(empty)
    if not lows:
        return [], np.empty((0, BINS), np.uint8), np.empty(0, bool)
    return fps, np.concatenate(lows), np.concatenate(empties)


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray) -> np.ndarray:
    """Corrected estimate of the Jaccard similarity from low bits (rows, BINS)."""
    chance = 2.0 ** -BITS
    est = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(empty_a & empty_b, 1.0, np.where(empty_a | empty_b, 0.0, est))


def _edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _compare(ids, texts, following):
    """Output columns of documents whose next texts are known."""
    edited = [_edited(t, f) for t, f in zip(texts, following)]
    fp, low, none = of_texts(texts)
    efp, elow, enone = of_texts(edited)
    _, flow, fnone = of_texts(following)
    return [ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited], fp, efp,
            likeness(low, elow, none, enone).tolist(), likeness(low, flow, none, fnone).tolist()]


def _walk(batches):
    """Documents of one sorted partition; its first and last text go out as border rows."""
    import pyarrow as pa

    last, seen, no = None, 0, 0
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def rows(ids, texts, following, border=()):
        cols = _compare(ids, texts, following)
        n = len(border)
        arrays = [pa.array([*c, *[None] * n], t) for c, t in zip(cols, kinds)]
        for j, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.large_string())):
            arrays.append(pa.array([*[None] * len(ids), *[b[j] for b in border]], t))
        arrays[-1] = arrays[-1].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in OUT.split(", ")] + [
            "part", "edge", "edge_id", "edge_text"])

    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
        if not ids:
            continue
        border = []
        if not seen:
            no = batch.column("part")[0].as_py()
            border.append((no, 0, ids[0], texts[0]))
        seen += len(ids)
        if last is not None:
            ids, texts = [last[0], *ids], [last[1], *texts]
        last = (ids[-1], texts[-1])
        for a in range(0, max(1, len(ids) - 1), 1000):
            b = min(len(ids) - 1, a + 1000)
            yield rows(ids[a:b], texts[a:b], texts[a + 1:b + 1], border if a == 0 else ())
    if seen:
        yield rows([], [], [], [(no, 1, last[0], last[1])])


def _border(batches):
    import pyarrow as pa

    for batch in batches:
        cols = _compare(batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()],
                        [t or "" for t in batch.column("next_text").to_pylist()])
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         names=[c.split()[0] for c in OUT.split(", ")])


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and likeness to both the edited and the next text."""
    parts = C.parts_of(docs.sparkSession)
    walked = materialize(C.arrow_map(
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id()), _walk,
        OUT + ", part int, edge int, edge_id long, edge_text string"))
    inner = walked.filter("edge is null").select(*[c.split()[0] for c in OUT.split(", ")])
    # one row per partition: its last document meets the first of the next partition that has any
    heads = walked.filter("edge = 0").select("part", F.col("edge_text").alias("next_text"))
    tails = walked.filter("edge = 1").select("part", F.col("edge_id").alias("doc_id"), F.col("edge_text").alias("text"))
    order = heads.selectExpr("part", "coalesce(lead(part) over (order by part), min(part) over ()) as following")
    border = tails.join(order, "part").join(heads.withColumnRenamed("part", "following"), "following")
    return inner.union(C.arrow_map(border.select("doc_id", "text", "next_text"), _border, OUT))
