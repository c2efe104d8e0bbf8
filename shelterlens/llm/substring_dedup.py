"""Substring deduplication by content-defined chunking with a gear rolling hash.

Texts are cut where the gear hash of the last 16 bytes (each byte's random number,
shifted left by its distance) falls below a threshold, so cuts depend on the text around
them and not on its place: after an insertion the old chunks come again. Chunks are
deduplicated by digest: the first occurrence by (doc_id, place) owns it, later ones are
repeats. What is removed are runs of repeated chunks of at least ``MIN_RUN`` bytes; a
short common phrase is no run. About 25 bytes a chunk make a passage of 50 words a dozen
chunks, of which only the two at its ends can differ.

Chunk digests travel as sorted numeric blocks to hash ranges. Repeats inside a map block
are settled there: a passage in a third of all documents adds one entry per block.

Defined results: null and empty texts have no chunks; rows that repeat a doc_id are one
document; rows without a doc_id are neither looked at nor changed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C

GEAR_BYTES = 16
THRESHOLD = 4588            # of 65536: a cut about every 25 bytes, see QUIET
QUIET = 7                   # no cut within this many bytes after a place that would be one
MAX_CHUNK = 4096
MIN_RUN = 100               # bytes of consecutive repeated chunks that are removed
STRONG, MIN_STRONG = 20, 60  # of which so many in chunks of this size: no run of mere short words
BLOCK_CHUNKS = 1_000_000
SUB_BUCKETS = 4

_GEAR = (C.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.uint16)


def cuts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ends of all chunks of the rows of a buffer, ascending; every row's end is one."""
    if not len(buf):
        return np.empty(0, np.int64)
    h = _GEAR[buf]
    for by in (1, 2, 4, 8):     # sums over 2, 4, 8, 16 bytes, each byte shifted by its distance
        h[by:] = h[by:] + (h[:-by] << np.uint16(by))
    hit = h < THRESHOLD
    row_start = off[:-1][off[:-1] < off[1:]]
    for k in range(GEAR_BYTES - 1):     # these hashes reach into the row before
        at = row_start + k
        hit[at[at < len(hit)]] = False
    near = np.zeros(len(hit), bool)
    for k in range(1, QUIET + 1):
        near[k:] |= hit[:-k]
    hit &= ~near
    hit[:-1] &= (buf[1:] & 0xC0) != 0x80        # never inside a character
    ends = np.flatnonzero(hit) + 1
    ends = np.union1d(ends, off[1:][off[:-1] < off[1:]])
    size = np.diff(ends, prepend=0)
    if (size > MAX_CHUNK).any():
        extra = []
        for e, s in zip(ends[size > MAX_CHUNK].tolist(), size[size > MAX_CHUNK].tolist()):
            for at in range(e - s + MAX_CHUNK, e, MAX_CHUNK):
                while at > e - s and buf[at] & 0xC0 == 0x80:
                    at -= 1
                extra.append(at)
        ends = np.union1d(ends, np.array(extra, np.int64))
    return ends


def chunks(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in the row, length, digest) of all chunks of a text column."""
    buf, off = C.text_buffer(column)
    ends = cuts(buf, off)
    starts = np.r_[0, ends[:-1]].astype(np.int64) if len(ends) else ends
    row = np.searchsorted(off, starts, "right") - 1
    return row, starts - off[row], ends - starts, C.word_hashes(buf, starts, ends)


# ---------------------------------------------------------------- repeats
def _to_docs(doc, start, length, other, buckets, doc_parts):
    part = C.id_bucket(doc, doc_parts)
    o = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[o], np.arange(doc_parts + 1))
    rows = []
    for p, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
        if b > a:
            i = o[a:b]
            rows.append((buckets + p, 1, C.pack(doc[i], start[i], length[i], other[i])))
    return rows


def _settle(h, doc, start, length):
    """Sorted by digest, place: (order, which are first of their digest, place of the first of each)."""
    o = np.lexsort((start, doc, h))
    h, doc, start, length = h[o], doc[o], start[o], length[o]
    again = np.zeros(len(h), bool)      # rows that repeat a document: the same place twice
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
    h, doc, start, length = h[~again], doc[~again], start[~again], length[~again]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    owner = doc[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(h) else doc
    return h, doc, start, length, first, owner


def _post(buckets: int, doc_parts: int):
    def flush(held):
        h, doc, start, length, first, owner = _settle(*(np.concatenate(c) for c in zip(*held)))
        rows = _to_docs(doc[~first], start[~first], length[~first], owner[~first], buckets, doc_parts)
        h, doc, start, length = h[first], doc[first], start[first], length[first]
        edge = C.bucket_bounds(h, buckets)
        for b in range(buckets):
            s = slice(edge[b], edge[b + 1])
            if edge[b + 1] > edge[b]:
                rows.append((b, 0, C.pack(h[s], doc[s], start[s], length[s])))
        return C.block_batch(rows)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a in range(0, batch.num_rows, 250):
                row, start, length, h = chunks(texts[a:a + 250])
                doc = ids[a:a + 250].to_numpy(zero_copy_only=False)[row]
                held.append((h, doc.astype(np.int64), start.astype(np.int32), length.astype(np.int16)))
                size += len(h)
                if size >= BLOCK_CHUNKS:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)
    return run


def _match(buckets: int, doc_parts: int):
    def run(batches):
        for part, blocks in C.runs(batches):
            if part >= buckets:
                yield C.block_batch([(part, k, b) for k, b in blocks])
                continue
            cols = zip(*[C.unpack(b, np.uint64, np.int64, np.int32, np.int16) for _, b in blocks])
            _, doc, start, length, first, owner = _settle(*(np.concatenate(c) for c in cols))
            yield C.block_batch(_to_docs(doc[~first], start[~first], length[~first], owner[~first],
                                         buckets, doc_parts))
    return run


def runs_of(doc, start, length, other):
    """Runs of adjoining repeated chunks that are long enough: (doc, start, length, chunks, other)."""
    o = np.lexsort((start, doc))
    doc, start, length, other = doc[o], start[o].astype(np.int64), length[o].astype(np.int64), other[o]
    once = np.ones(len(doc), bool)
    once[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
    doc, start, length, other = doc[once], start[once], length[once], other[once]
    if not len(doc):
        return [np.empty(0, np.int64)] * 5
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + length[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(length, at)
    strong = np.add.reduceat(np.where(length >= STRONG, length, 0), at)
    n = np.diff(np.r_[at, len(doc)])
    # the document that the longest chunk of the run was met in
    run = np.cumsum(new) - 1
    longest = np.lexsort((-length, run))[at]
    keep = (total >= MIN_RUN) & (strong >= MIN_STRONG)
    return [c[keep] for c in (doc[at], start[at], total, n, other[longest])]


def _gather(batches):
    import pyarrow as pa

    for _, blocks in C.runs(batches):
        cols = zip(*[C.unpack(b, np.int64, np.int32, np.int16, np.int64) for _, b in blocks])
        found = runs_of(*(np.concatenate(c) for c in cols))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found],
                                         names=["doc_id", "start", "length", "chunks", "also_in"])


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, chunks, also_in): passages that an earlier place already has.

    start and length count UTF-8 bytes; also_in is a document that has the passage too
    (an earlier one, or the same one if the passage repeats within it).
    """
    parts = C.parts_of(docs.sparkSession)
    buckets = parts * SUB_BUCKETS
    posted = C.arrow_map(docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text"),
                         _post(buckets, parts), C.BLOCK_SCHEMA)
    matched = C.arrow_map(C.dealt(posted, parts), _match(buckets, parts), C.BLOCK_SCHEMA)
    return C.arrow_map(C.dealt(matched, parts), _gather, "doc_id long, start long, length long, chunks long, also_in long")


def _cut_out(spans_name: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(spans_name).to_pylist()):
                if spans:
                    raw, kept, pos = text.encode(), [], 0
                    for s in sorted(spans, key=lambda s: s["start"]):
                        kept.append(raw[pos:s["start"]])
                        pos = s["start"] + s["length"]
                    kept.append(raw[pos:])
                    text = b"\n".join(k for k in kept if k).decode()
                out.append(text)
            names = [n for n in batch.schema.names if n != spans_name]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, batch.schema.field(n).type) if n == "text" else batch.column(n) for n in names], names=names)
    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """Documents with their repeated passages cut out; one that had nothing else is left out.

    All columns stay, whatever their names; n_chars, where there is one, is counted anew for texts that changed.
    """
    def free(name):
        while name in docs.columns:
            name += "_"
        return name
    ids, cuts, changed = free("__sd_id"), free("__sd_spans"), free("__sd_cut")
    spans = repeats(docs).groupBy(F.col("doc_id").alias(ids)).agg(F.collect_list(F.struct("start", "length")).alias(cuts))
    joined = docs.join(spans, docs["doc_id"] == spans[ids], "left").drop(ids)
    schema, own = docs.schema, [F.col(f"`{c}`") for c in docs.columns]
    out = C.arrow_map(joined.select(*own, cuts, F.col(cuts).isNotNull().alias(changed)), _cut_out(cuts),
                      ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", `{changed}` boolean")
    out = out.filter(f"not `{changed}` or length(trim(text)) > 0")
    if "n_chars" in docs.columns:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*own)
