"""Shared pieces of the training-data operators.

* ``WORD``: a word is a run of bytes other than ASCII white space (x20, x09-x0D);
* ``word_index`` / ``shingle_sets``: 64-bit word and 5-word shingle hashes of a whole
  Arrow batch at once (numpy over the text buffer, no per-word Python);
* ``pack`` / ``unpack`` and ``exchange_*``: rows of one shuffle partition travel as one
  binary block of sorted numbers instead of millions of tiny rows;
* ``connected``: connected components as Spark jobs (large star / small star).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.session import materialize

SHINGLE = 5
CHUNK_BYTES = 2 << 20   # text handled at a time
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S32, _S29 = np.uint64(32), np.uint64(29)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()
_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "16m"
BATCH_ROWS = 1000   # rows of an Arrow batch where the session has no setting of its own


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, whatever their working folder is,
    and keep Arrow batches of whole texts and blocks small (they lie outside the JVM heap, several at once).

    The batch settings are the session's: where they have Spark's defaults, they stay changed after the call.
    """
    import pathlib
    import tempfile
    import zipfile

    if spark.conf.get(_RECORDS) == "10000":   # Spark's default: too many for whole texts
        spark.conf.set(_RECORDS, str(BATCH_ROWS))
    if spark.conf.get(_BYTES) in ("64MB", "64m", "67108864", "67108864b"):     # Spark's default
        spark.conf.set(_BYTES, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = pathlib.Path(__file__).resolve().parents[1]
    path = pathlib.Path(tempfile.mkdtemp(prefix="shelterlens-py-")) / "shelterlens_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def parts_of(spark: SparkSession) -> int:
    """Shuffle width: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _S32)
    x = x * _C1
    x = x ^ (x >> _S29)
    x = x * _C2
    return x ^ (x >> _S32)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column (null: empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[off[0]:off[-1]] if n else buf[:0], (off - off[0]) if n else np.zeros(1, np.int64)


def word_spans(buf: np.ndarray, off: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and one past the last) of all words, the runs of bytes not ``blank``."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~blank[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = solid[:-1]
    inner = off[:-1][off[:-1] < off[1:]]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(buf), bool)
    after[:-1] = solid[1:]
    last = off[1:][off[:-1] < off[1:]] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, eight bytes a round over all words that are that long."""
    length = ends - starts
    h = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(starts):
        return h
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    at = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    live, step = np.arange(len(starts)), 0
    while len(live):
        left = length[live] - step
        h[live] = mix(h[live] ^ (at[starts[live] + step] & _MASK[np.minimum(left, 8)]))
        step += 8
        live = live[left > 8]
    return h


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[buf]


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Order-aware hash of every run of ``size`` word hashes (rows are not told apart)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    s = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        s = (s ^ h[k:k + n]) * _C1
        s ^= s >> _S32
    return s


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-word shingle hashes of every row, sorted within the row: (hashes, offsets).

    Rows with one to four words have one shingle, the whole sequence; rows without
    words have none. A-Z is lower-cased first.
    """
    buf, off = text_buffer(column)
    if off[-1] > CHUNK_BYTES and len(off) > 2:  # long columns in pieces: numbers take several times the text's memory
        cut = np.unique(np.r_[0, np.searchsorted(off, np.arange(CHUNK_BYTES, off[-1], CHUNK_BYTES)), len(off) - 1])
        if len(cut) == 2:
            cut = np.arange(len(off))
        found = [shingle_sets(column[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        sizes = np.concatenate([np.diff(o) for _, o in found])
        return np.concatenate([h for h, _ in found]), np.r_[0, np.cumsum(sizes)]
    buf = lowered(buf)
    starts, ends, first = word_spans(buf, off)
    h = word_hashes(buf, starts, ends)
    full = window_hashes(h, SHINGLE)
    short = [None] + [window_hashes(h, k) for k in range(1, SHINGLE)]
    out, sizes = [], np.zeros(len(off) - 1, np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        n = b - a
        if n >= SHINGLE:
            s = np.sort(full[a:b - SHINGLE + 1])
            if len(s) > 1:
                s = s[np.r_[True, s[1:] != s[:-1]]]
        elif n:
            s = short[n][a:a + 1]
        else:
            continue
        out.append(s)
        sizes[i] = len(s)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.r_[0, np.cumsum(sizes)]


# ---------------------------------------------------------------- blocks of numbers in one shuffle row
def planes(a: np.ndarray) -> bytes:
    """Byte planes of a fixed-width array: high bytes of small numbers lie together and compress away."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplanes(raw, dtype, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(dtype)


def pack(*columns: np.ndarray) -> bytes:
    """Equally long arrays as one block; an ascending uint64 column goes as its steps."""
    n = len(columns[0])
    return np.int64(n).tobytes() + b"".join(
        planes(np.diff(c, prepend=np.uint64(0)) if c.dtype == np.uint64 else c) for c in columns)


def unpack(raw: bytes, *dtypes) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(raw[:8], np.int64)[0]), 8, []
    for d in dtypes:
        width = np.dtype(d).itemsize * n
        c = unplanes(raw[at:at + width], d, n) if n else np.empty(0, d)
        out.append(np.cumsum(c, dtype=np.uint64) if np.dtype(d) == np.uint64 else c)
        at += width
    return out


BLOCK_SCHEMA = "part int, kind int, block binary"


def block_batch(rows: list[tuple[int, int, bytes]]):
    import pyarrow as pa

    part, kind, block = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.binary())],
        names=["part", "kind", "block"])


def block_batches(rows: list[tuple[int, int, bytes]], most: int = 4 << 20):
    """``rows`` as batches of a few MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= most:
            yield block_batch(held)
            held, size = [], 0
    if held:
        yield block_batch(held)


def dealt(df: DataFrame, parts: int) -> DataFrame:
    """Blocks to their part, rows of one part next to each other (Spark's sort spills to disk)."""
    return df.repartition(parts, "part").sortWithinPartitions("part", "kind")


def runs(batches):
    """(part, [(kind, block), ...]) for each part of a partition sorted by part."""
    now, held = None, []
    for batch in batches:
        for part, kind, block in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(),
                                     batch.column("block")):
            if part != now:
                if held:
                    yield now, held
                now, held = part, []
            held.append((kind, block.as_py()))
    if held:
        yield now, held


def bucket_bounds(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the hash space starts in a sorted array."""
    edge = [(b << 64) // buckets for b in range(1, buckets)]
    return np.r_[0, np.searchsorted(sorted_hashes, np.array(edge, np.uint64)), len(sorted_hashes)]


def id_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


# ---------------------------------------------------------------- components
CHUNK_EDGES = 500_000   # edges that a task contracts at a time


def _contract(batches):
    """Edges of a partition, in chunks, to one edge per vertex: to the smallest of its local component."""
    import pyarrow as pa

    def stars(us, vs):
        root: dict[int, int] = {}

        def find(x):
            while (y := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(y, y)
            return x

        for u, v in zip(us, vs):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
        found = [(x, find(x)) for x in list(root)]
        u, v = zip(*[f for f in found if f[0] != f[1]])
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    us, vs = [], []
    for batch in batches:
        us += batch.column("u").to_pylist()
        vs += batch.column("v").to_pylist()
        if len(us) >= CHUNK_EDGES:
            yield stars(us, vs)
            us, vs = [], []
    if us:
        yield stars(us, vs)


def connected(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Smallest vertex reachable from each vertex of an edge list: (node, component).

    ``edges`` has columns a, b (long). Partitions contract their own edges first, then
    large-star / small-star rounds run until nothing changes: joins on the smallest
    neighbour, pre-aggregated before the shuffle, each round written to the shared
    folder. Only one checksum row a round comes to the driver.
    """
    def mark(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    pairs = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("u <> v").distinct())
    e = materialize(arrow_map(pairs, _contract, "u long, v long"))
    before = mark(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours go to the smallest vertex of the neighbourhood
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: a vertex and its smaller neighbours go to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = materialize(star)
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
