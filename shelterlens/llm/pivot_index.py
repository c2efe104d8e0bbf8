"""Embedding near-dedup: vectors of one label whose cosine is 0.93 or more.

Method: a pivot-permutation index. Every vector is described by its NEAREST pivots (reference
vectors); near vectors have nearly the same ones. Two vectors are candidates if they share
SHARED pivots or more, and candidates are verified by their cosine in double precision.

1. Equal vectors of a label collapse to one class with its smallest vec_id (``classes``).
   A class is known by two 64-bit hashes of its vector.
2. Pivots: of a bounded sample of distinct vectors (the SAMPLE smallest hashes) at most
   PIVOTS, in hash order, none within the threshold of another (``pivots``). Only the pivots
   are fitted on the sample; every class is indexed.
3. Inverted lists: pivots are numbered from the rarest of the sample to the most frequent.
   Two descriptions that share SHARED of NEAREST pivots share two among the first NEAREST -
   SHARED + 2 of each (prefix filter), so lists are kept per label and pair of pivots, and
   a pair of vectors is looked at in the list of its two first common pivots only. Lists of
   one vector go before any vector is moved.
4. Units of bounded size count shared pivots and verify: short lists share a unit, a list of
   more than BLOCK vectors is cut into blocks, each pair of blocks being a unit. A unit
   returns sums of links per class and a spanning edge per linked class, never all pairs.
5. Components of the edges as Spark jobs; links of a class add up over its units.

The index is approximate: a near pair with fewer shared pivots is missed. Recall on all
near pairs of the larger tables is above 0.999 (tests measure it against brute force, 0.9 at
least). No pair below the threshold is linked.

Defined results: null, zero and empty vectors, vectors with null or non-finite components and
those without a label link with nothing, and vectors of different lengths do not link; repeated
rows are all returned and are one vector; a row without a vec_id is returned with no links,
no component, kept. Rows of one vec_id with different vectors are one vertex of the
components; n_links is the largest of theirs. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

THRESHOLD = 0.93
PIVOTS = 1024
SAMPLE = 8192            # distinct vectors that the pivots are chosen from
SAMPLE_VALUES = 1 << 22  # and at most so many components of them
NEAREST, SHARED = 8, 4   # pivots of a description; how many of them candidates share
BLOCK = 2048             # vectors of a list that a unit holds on each side
UNIT_VALUES = 1 << 22    # components of the vectors in a unit of short lists
HOT_CLASSES = 1024       # at most so many classes hold more than 1 / HOT_CLASSES of the rows
PAIRS = 1 << 16          # pairs looked at in one numpy step


# ---------------------------------------------------------------- 1 classes
def _usable(vector: str) -> Column:
    """Finite and not zero."""
    v = F.col(vector)
    inf = F.lit(float("inf"))
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < inf), F.lit(False)))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def _rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, space, h1, h2, vector) of the vectors that can link; a space is a label and a length."""
    return (vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).filter(_usable("vector"))
            .select("vec_id", F.concat_ws(":", F.size("vector").cast("string"), F.col("label").cast("string")).alias("space"),
                    F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"), "vector"))


CLASS = ["space", "h1", "h2"]


def _classes(rows: DataFrame) -> DataFrame:
    """(space, h1, h2, rep, copies, vector, cid): one row per distinct vector of a space."""
    members = rows.groupBy(*CLASS, "vec_id").agg(F.any_value("vector").alias("vector"))
    return (members.groupBy(*CLASS).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
                                        F.any_value("vector").alias("vector"))
            .withColumn("cid", F.monotonically_increasing_id()))   # fixed by writing the table


# ---------------------------------------------------------------- 2 pivots
def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, however large or small their components are."""
    m = matrix.astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _matrix(column, width: int) -> np.ndarray:
    """Arrow lists (finite, not empty) as rows of ``width`` numbers, short ones filled with zeros."""
    values, size = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy()
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    here = place < width
    out[row[here], place[here]] = values[here]
    return out


def _described(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of the NEAREST pivots of each row, ascending; with fewer pivots all rows share the missing ones."""
    k = min(NEAREST, len(pivots))
    near = np.argpartition(-(unit @ pivots.T), k - 1, axis=1)[:, :k]
    missing = np.broadcast_to(np.arange(len(pivots), len(pivots) + NEAREST - k), (len(unit), NEAREST - k))
    return np.sort(np.concatenate([near, missing], axis=1), axis=1)


def pivots(classes: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Reference vectors from a bounded sample of the classes, the rarest near one first."""
    import pyarrow as pa

    width = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    rows = max(16, min(sample, SAMPLE_VALUES // width))
    got = classes.select("h1", "vector").orderBy("h1", "vector").limit(rows).toArrow()
    if not got.num_rows:
        return np.empty((0, width))
    column = got.column("vector").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    width = min(width, SAMPLE_VALUES // 16)
    known = _matrix(column, width)
    known = _unit(known[np.abs(known).max(1) > 0])
    open_, chosen = np.ones(len(known), bool), []
    for x in range(len(known)):
        if open_[x]:
            chosen.append(x)
            if len(chosen) == count:
                break
            open_ &= known @ known[x] < THRESHOLD
    found = known[chosen]
    often = np.bincount(_described(known, found).ravel(), minlength=len(found))
    return found[np.argsort(often[:len(found)], kind="stable")]


# ---------------------------------------------------------------- 3 lists
def _near(shared_pivots):
    def run(batches):
        import pyarrow as pa

        p = shared_pivots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("vector")
            m = _matrix(column, p.shape[1])
            blank = np.abs(m).max(1) == 0       # all that the pivots' width shows is zero
            m[blank, 0] = 1
            near = _described(_unit(m), p).astype(np.int16)
            flat = pa.array(near.ravel(), pa.int16())
            off = pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), batch.column("space"), pa.ListArray.from_arrays(off, flat)],
                names=["cid", "space", "near"])
    return run


def _lists(near: DataFrame, shared: int) -> DataFrame:
    """(cid, space, p, q): the lists of a class, by pairs of the first pivots of its description."""
    first = F.slice("near", 1, NEAREST - shared + 2)
    pairs = F.flatten(F.transform(first, lambda x, i: F.transform(
        F.slice(first, i + 2, F.size(first)), lambda y: F.struct(x.alias("p"), y.alias("q")))))
    return near.select("cid", "space", F.explode(pairs).alias("l")).select("cid", "space", "l.p", "l.q")


def _units(near: DataFrame, vectors: DataFrame, shared: int, parts: int, width: int) -> DataFrame:
    """Entries of the lists by unit (u1, u2): class, list, side and vector."""
    lists = _lists(near, shared)
    sizes = materialize(lists.groupBy("space", "p", "q").agg(F.count("*").alias("n")).filter("n > 1"))
    short = sizes.filter(F.col("n") <= BLOCK).agg(F.sum("n")).first()[0] or 0
    units = int(short * width // UNIT_VALUES) * 2 + parts
    placed = lists.join(sizes, ["space", "p", "q"])
    key = F.xxhash64("space", "p", "q")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "cid"), blocks).cast("int")
    where = F.when(F.col("n") <= BLOCK, F.array(F.struct(
        F.pmod(key, F.lit(units)).alias("u1"), F.lit("").alias("u2"), F.lit(0).alias("side")))).otherwise(
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(
            key.alias("u1"), F.concat_ws(",", F.least(own, o).cast("string"), F.greatest(own, o).cast("string")).alias("u2"),
            F.when(own > o, 1).otherwise(0).alias("side"))))
    # one row per class with its lists (a bounded number), so that its vector moves once to meet them
    own_lists = (placed.select("cid", F.explode(where).alias("w"), F.struct("p", "q").alias("l"))
                 .groupBy("cid").agg(F.collect_list(F.struct("w", "l")).alias("at")))
    entries = (own_lists.join(near, "cid").join(vectors.select("cid", "rep", "copies", "vector"), "cid")
               .select("cid", "space", "rep", "copies", "near", "vector", F.explode("at").alias("at")))
    return entries.select("at.w.*", "at.l.*", "cid", "space", "rep", "copies", "near", "vector")


# ---------------------------------------------------------------- 4 verification
def _pairs(count: np.ndarray, first: np.ndarray):
    """Index pairs (i, j) in pieces: row i with the ``count[i]`` rows from ``first[i]`` on."""
    total = np.cumsum(count)
    a = 0
    while a < len(count):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + PAIRS, "right")))
        c = count[a:b]
        i = np.repeat(np.arange(a, b), c)
        if len(i):
            yield i, first[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        a = b


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of linked rows; a root is the smallest row of its tree."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _verify_unit(threshold: float, shared: int):
    def run(key, frame):
        import pandas as pd

        frame = frame.sort_values(["space", "p", "q", "side"], kind="stable")
        space, p, q = (frame[c].to_numpy() for c in ("space", "p", "q"))
        n = len(frame)
        change = np.r_[True, (space[1:] != space[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])]
        start = np.flatnonzero(change)
        stop = np.repeat(np.r_[start[1:], n], np.diff(np.r_[start, n]))     # end of each row's list
        blocks = str(key[1]).split(",")
        if len(blocks) == 2 and blocks[0] != blocks[1]:     # two blocks of one list: pairs across only
            zeros = int((frame["side"].to_numpy() == 0).sum())
            first = np.full(n, zeros)
            count = np.where(np.arange(n) < zeros, n - zeros, 0)
        else:
            first = np.arange(n) + 1
            count = stop - first
        near = np.stack(frame["near"].to_numpy())
        copies, rep, cid = (frame[c].to_numpy() for c in ("copies", "rep", "cid"))
        unit = np.zeros((n, frame["vector"].map(len).max()))
        for x, v in enumerate(frame["vector"]):
            unit[x, :len(v)] = v
        unit = _unit(unit)
        met, root = np.zeros(n, np.int64), np.arange(n)
        for i, j in _pairs(count, first):
            common = (near[i][:, :, None] == near[j][:, None, :]).any(2)
            one = common.argmax(1)
            rest = common.copy()
            rest[np.arange(len(i)), one] = False
            two = rest.argmax(1)
            mine = (common.sum(1) >= shared) & (near[i, one] == p[i]) & (near[i, two] == q[i])
            i, j = i[mine], j[mine]
            near_by = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[near_by], j[near_by]
            np.add.at(met, i, copies[j])
            np.add.at(met, j, copies[i])
            _merge(root, i, j)
        linked = np.flatnonzero(root != np.arange(n))
        rows = [(int(a), int(b), None) for a, b in zip(rep[linked], rep[root[linked]])]
        seen = np.flatnonzero(met)
        if len(seen):
            ids, place = np.unique(cid[seen], return_inverse=True)
            rows += [(int(c), None, int(k)) for c, k in zip(ids, np.bincount(place, met[seen]).astype(np.int64))]
        return pd.DataFrame(rows, columns=["a", "b", "met"]).astype("Int64")
    return run


# ---------------------------------------------------------------- 5 the operator
def near_links(vectors: DataFrame, threshold: float = THRESHOLD, shared: int = SHARED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors (vec_id, embedding, label).

    n_links: other vectors of the label at ``threshold`` or more; component_id: the smallest vec_id
    reachable by links; kept: it is the row's own.
    """
    spark = vectors.sparkSession
    rows = _rows(vectors)
    classes = materialize(_classes(rows))
    reference = pivots(classes)
    C.ship(spark)
    shared_pivots = spark.sparkContext.broadcast(reference)     # at most PIVOTS vectors
    if len(reference):
        near = materialize(classes.select("cid", "space", "vector").mapInArrow(
            _near(shared_pivots), "cid long, space string, near array<smallint>"))
        units = _units(near, classes, shared, C.parts_of(spark), reference.shape[1])
        verified = materialize(units.groupBy("u1", "u2").applyInPandas(
            _verify_unit(threshold, shared), "a long, b long, met long"))
    else:
        verified = spark.createDataFrame([], "a long, b long, met long")
    met = verified.filter("met is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("met").alias("met"))
    counted = materialize(classes.select(*CLASS, "cid", "rep", "copies").join(met, "cid", "left")
                          .withColumn("n_links", F.col("copies") - 1 + F.coalesce("met", F.lit(0)))
                          .filter("n_links > 0").select(*CLASS, "rep", "copies", "n_links"))
    members = _members(rows.select("vec_id", *CLASS), counted)
    numbers = members.groupBy("vec_id").agg(F.max("n_links").alias("n_links"))
    edges = verified.filter("b is not null").select("a", "b").union(
        members.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    found = C.connected(edges)
    return (vectors.select("vec_id").join(numbers, "vec_id", "left")
            .join(found.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").cast("long").alias("component_id"))
            .withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id"))))


def _members(rows: DataFrame, counted: DataFrame) -> DataFrame:
    """(vec_id, rep, n_links) of the rows of the counted classes.

    Classes with more than 1 / HOT_CLASSES of the rows are at most HOT_CLASSES: they meet their
    rows in a broadcast join, so no task gets all copies of one vector.
    """
    most = rows.count() // HOT_CLASSES
    hot = F.broadcast(counted.filter(F.col("copies") > most))
    rest = counted.filter(F.col("copies") <= most)
    return materialize(
        rows.join(hot, CLASS).select("vec_id", "rep", "n_links").union(
            rows.join(hot.select(*CLASS), CLASS, "left_anti").join(rest, CLASS).select("vec_id", "rep", "n_links")))


def keep_one(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One vector of each group stays, the one with the smallest vec_id; all columns kept."""
    gone = near_links(vectors, threshold).filter(~F.col("kept")).select("vec_id").distinct()
    return vectors.join(materialize(gone), "vec_id", "left_anti").select(*vectors.columns)
