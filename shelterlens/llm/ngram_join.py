"""N-gram Jaccard join: documents whose 5-word shingle sets overlap by 75 % or more.

Method: size-aware heavy-light join. A set that may link needs a partner sharing at
least ``need(n) = ceil(0.75 n)`` of its shingles. Small sets enumerate fixed-size subsets
(pairs) of a prefix of their shingles, large sets are scanned through inverted lists of
a prefix; the size boundary is where the estimated cost of both is least (``boundary``).

1. ``shared_shingles``: one pass over the texts. Shingles that only one document has can
   never be common to two, so a document can link only if 75 % of its shingles occur
   elsewhere. Shingle hashes travel as sorted numeric blocks, at most one entry per
   shingle and map block; what repeats inside a block is settled there, so a passage of
   a third of all documents adds one entry per block, not one per document.
2. Equal sets collapse to their smallest doc_id (``classes``).
3. Rarest-first order by exact document frequency; light and heavy keys of the prefixes.
   Sharing a key is necessary for a link, so documents joined by keys form clusters.
4. Each cluster is verified exactly: inverted-list scans count every overlap. Small
   clusters share a task; large ones are cut into blocks of documents and verified block
   pair by block pair, so no task holds an unbounded cluster.
5. Links to components (``connected``). Every pair meets in one unit, so the units' counts
   of hits add up to each document's number of links (``jaccard_links``).

Defined results: null and empty texts have no shingles and link with nothing; repeated
rows are all returned, rows with the same doc_id are one vertex; rows without a doc_id
are left out of the result of the join and always kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import materialize

BLOCK_SHINGLES = 500_000   # shingles of documents that are combined before they are shuffled
UNIT_ENTRIES = 600_000       # shingles that one verification task holds
SUBSET = 2                   # size of the enumerated subsets
LIST_COST = 5.0              # cost of a posting in an inverted list, in enumerated subsets
FOUND = 500_000              # shared entries that a matching task holds before it sends them
SUB_BUCKETS = 4              # hash ranges per shuffle partition, handled one after another


def need(n):
    """Least overlap of a set of n shingles with any partner at similarity 0.75."""
    return -(-3 * n // 4)


# ---------------------------------------------------------------- 1 shared shingles
def _post(buckets: int, doc_parts: int):
    def flush(ids, hashes, sizes):
        ids, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        d = np.repeat(ids, sizes)
        o = np.argsort(h, kind="stable")
        h, d = h[o], d[o]
        del o
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        known = np.zeros(len(h), bool)      # occurs again in this block: shared already
        known[:-1] |= ~first[1:]
        known |= ~first
        rows = []
        ph, pd, pk = h[first], d[first], known[first]
        edge = C.bucket_bounds(ph, buckets)
        for b in range(buckets):
            x, y = edge[b], edge[b + 1]
            if y > x:
                rows.append((b, 0, C.pack(ph[x:y], pd[x:y], pk[x:y].view(np.int8))))
        rows += _to_docs(h[known], d[known], buckets, doc_parts)
        part = C.id_bucket(ids, doc_parts)
        for p in np.unique(part):
            m = part == p
            rows.append((buckets + int(p), 1, C.pack(ids[m], sizes[m])))
        return C.block_batches(rows)

    def run(batches):
        ids, hashes, sizes, held = [], [], [], 0
        for batch in batches:
            h, off = C.shingle_sets(batch.column("text"))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                if doc is None:
                    continue
                s = h[off[i]:off[i + 1]]
                ids.append(doc)
                sizes.append(len(s))
                hashes.append(s)
                held += len(s)
                if held >= BLOCK_SHINGLES:
                    yield from flush(ids, hashes, sizes)
                    ids, hashes, sizes, held = [], [], [], 0
        if ids:
            yield from flush(ids, hashes, sizes)
    return run


def _to_docs(h, d, buckets, doc_parts):
    """Shared entries (hash, doc) as blocks for the documents' own parts, each sorted by hash."""
    part = C.id_bucket(d, doc_parts)
    o = np.argsort(part, kind="stable")
    h, d, part = h[o], d[o], part[o]
    edge = np.searchsorted(part, np.arange(doc_parts + 1))
    return [(buckets + p, 2, C.pack(h[a:b], d[a:b]))
            for p, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if b > a]


def _match(buckets: int, doc_parts: int):
    """Hash parts: entries met in two blocks are shared. Document parts pass through, batch by batch."""
    def shared(blocks):
        h, d, k = (np.concatenate(c) for c in zip(*(C.unpack(b, np.uint64, np.int64, np.int8) for b in blocks)))
        o = np.argsort(h, kind="stable")
        h, d, k = h[o], d[o], k[o]
        same = np.zeros(len(h), bool)
        same[1:] = h[1:] == h[:-1]
        same[:-1] |= same[1:]
        new = same & (k == 0)
        return h[new], d[new]

    def run(batches):
        import pyarrow as pa

        found, held, now, blocks = [], 0, None, []

        def settle(final):
            nonlocal found, held, blocks
            if blocks:
                found.append(shared(blocks))
                held += len(found[-1][0])
                blocks = []
            if found and (final or held > FOUND):
                yield from C.block_batches(_to_docs(*_by_hash(*(np.concatenate(c) for c in zip(*found))), buckets, doc_parts))
                found, held = [], 0

        for batch in batches:
            mine = batch.column("part").to_numpy() < buckets
            if not mine.all():
                yield batch.filter(pa.array(~mine))
            if mine.any():
                own = batch.filter(pa.array(mine))
                for part, block in zip(own.column("part").to_pylist(), own.column("block")):
                    if part != now:
                        yield from settle(False)
                        now = part
                    blocks.append(block.as_py())
        yield from settle(True)
    return run


def _by_hash(h, d):
    o = np.argsort(h, kind="stable")
    return h[o], d[o]


def _gather(batches):
    """Document parts: one row per document, with its shared shingles if it can link at all."""
    import pyarrow as pa

    for _, blocks in C.runs(batches):
        heads = [C.unpack(b, np.int64, np.int64) for k, b in blocks if k == 1]
        marks = [C.unpack(b, np.uint64, np.int64) for k, b in blocks if k == 2]
        ids, n = (np.concatenate(c) for c in zip(*heads))
        h, d = (np.concatenate(c) for c in zip(*marks)) if marks else (np.empty(0, np.uint64), np.empty(0, np.int64))
        o = np.lexsort((h, d))
        h, d = h[o], d[o]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, d = h[keep], d[keep]
        a, b = np.searchsorted(d, ids), np.searchsorted(d, ids, "right")
        able = (n > 0) & (4 * (b - a) >= 3 * n)
        for x in range(0, len(ids), 5000):
            sl = slice(x, x + 5000)
            sets = [h[i:j].view(np.int64) if ok else None for i, j, ok in zip(a[sl], b[sl], able[sl])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[sl]), pa.array(n[sl]), pa.array(sets, pa.list_(pa.int64()))],
                names=["doc_id", "n", "shared"])


def shared_shingles(docs: DataFrame) -> DataFrame:
    """(doc_id, n, shared): set size, and the shingles other documents have too - null
    where they are less than 75 % of the set, so that the document cannot link."""
    parts = C.parts_of(docs.sparkSession)
    buckets = doc_parts = parts * SUB_BUCKETS
    posted = C.arrow_map(docs.select("doc_id", "text"), _post(buckets, doc_parts), C.BLOCK_SCHEMA)
    matched = C.arrow_map(C.dealt(posted, parts), _match(buckets, doc_parts), C.BLOCK_SCHEMA)
    return C.arrow_map(C.dealt(matched, parts), _gather, "doc_id long, n long, shared array<bigint>")


# ---------------------------------------------------------------- 3 keys
def boundary(sizes: list[tuple[int, int]], list_cost: float = LIST_COST) -> int:
    """Size up to which enumerating subsets costs no more than scanning lists.

    ``sizes``: (set size, number of sets). A light set of size n emits C(q, 2) subsets of
    its prefix of q = n - need(n) + 2 shingles; a listed one emits q - 1 postings, each of
    which costs ``list_cost`` subsets: a list joins its members to one of them, however
    long it is, but one shared shingle lets more strangers pass to verification than a
    shared pair does. Sets down to 75 % of the boundary are listed too, because a larger
    partner finds them there.
    """
    best, at = None, 0
    for b in [0, *sorted({n for n, _ in sizes})]:
        cost = 0.0
        for n, c in sizes:
            q = n - need(n) + SUBSET
            if n <= b:
                cost += c * q * (q - 1) / 2
            if n > 0.75 * b:
                cost += c * (q - 1) * list_cost
        if best is None or cost < best:
            best, at = cost, b
    return at


def join_keys(sets: DataFrame, light: int) -> DataFrame:
    """(key, doc_id) of sets (doc_id, n, items): items shared shingles, rarest first.

    Singletons are the rarest of all and stand before the items, so the prefix holds
    that many items less.
    """
    q = F.expr(f"cast(n - ceil(0.75 * n) + {SUBSET} - (n - size(items)) as int)")

    def prefix(length):
        return F.slice("items", F.lit(1), F.greatest(F.lit(0), length))

    pairs = F.expr("""flatten(transform(px, (x, i) ->
                      transform(slice(px, i + 2, size(px)), y -> xxhash64(2, x, y))))""")
    small = (sets.filter(F.col("n") <= light).select("doc_id", prefix(q).alias("px"))
             .select(F.explode(pairs).alias("key"), "doc_id"))
    listed = (sets.filter(F.col("n") > 0.75 * light)
              .select(F.explode(prefix(q - F.lit(SUBSET - 1))).alias("item"), "doc_id")
              .select(F.xxhash64(F.lit(1), "item").alias("key"), "doc_id"))
    return small.union(listed)


# ---------------------------------------------------------------- 4 verification
def _links(ids, sizes, items, side=None, copies=None, met_copies=None):
    """Spanning links (a, b) of the documents of one unit, every overlap counted exactly.

    ``side``: 0 or 1 per document; with two sides only pairs across are looked at.
    ``copies``: members of the class that each document stands for; ``met_copies`` gets the
    sum of them over all documents that one links with.
    """
    lengths = np.array([len(x) for x in items], np.int64)
    flat = np.concatenate(items) if len(items) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(ids)), lengths)
    _, token = np.unique(flat, return_inverse=True)
    order = np.argsort(token, kind="stable")
    listed, start = owner[order], np.searchsorted(token[order], np.arange(len(np.unique(token)) + 1))
    off = np.r_[0, np.cumsum(lengths)]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x in range(len(ids)):
        t = token[off[x]:off[x + 1]]
        t = t[start[t + 1] - start[t] > 1]
        if not len(t):
            continue
        met = np.concatenate([listed[start[k]:start[k + 1]] for k in t.tolist()])
        met = met[met < x]
        if side is not None:
            met = met[side[met] != side[x]]
        if not len(met):
            continue
        who, common = np.unique(met, return_counts=True)
        hit = who[100 * common >= 75 * (sizes[who] + sizes[x] - common)]
        if met_copies is not None:
            met_copies[hit] += copies[x]
            met_copies[x] += copies[hit].sum()
        for y in hit.tolist():
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((ids[x], ids[y]))
    return out


def _verify(key, frame):
    import pandas as pd

    ids, sizes, copies = (frame[c].to_numpy() for c in ("doc_id", "n", "copies"))
    # a unit of two blocks looks at pairs across only, also if one of the blocks is empty
    met, side = np.zeros(len(ids), np.int64), frame["side"].to_numpy() if key[1] != key[2] else None
    links = _links(ids, sizes, list(frame["items"]), side, copies, met)
    rows = [(a, b, 0) for a, b in links] + [(i, i, k) for i, k in zip(ids.tolist(), met.tolist()) if k]
    return pd.DataFrame(rows, columns=["a", "b", "met"], dtype="int64")


def verified_links(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """Links (a, b, 0) within the clusters (doc_id, cluster) of the sets (doc_id, n, items,
    copies), enough to span what links join, and (a, a, met): copies that a links with in a unit.

    Units of work: clusters of at most UNIT_ENTRIES shingles share units by hash; a larger
    one is dealt over ``k`` blocks by document and each pair of blocks is one unit, so a
    unit's size is bounded however large the cluster is.
    """
    sized = sets.join(clusters, "doc_id")
    load = clusters.join(sets.select("doc_id", F.size("items").alias("e")), "doc_id").groupBy("cluster").agg(
        F.sum("e").alias("entries"))
    load = materialize(load)
    small_total = load.filter(F.col("entries") <= UNIT_ENTRIES).agg(F.sum("entries")).first()[0] or 0
    units = int(small_total // UNIT_ENTRIES) * 2 + C.parts_of(sets.sparkSession)
    load = load.withColumn("k", F.ceil(F.col("entries") / UNIT_ENTRIES).cast("int"))
    small = (sized.join(load.filter("k <= 1"), "cluster")
             .select(F.pmod(F.xxhash64("cluster"), F.lit(units)).alias("u1"), F.lit(-1).alias("u2"),
                     F.lit(-1).alias("u3"), "doc_id", "n", "items", "copies", F.lit(0).alias("side")))
    big = sized.join(load.filter("k > 1"), "cluster").withColumn(
        "own", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.col("k")).cast("int"))
    big = (big.withColumn("other", F.explode(F.expr("sequence(0, k - 1)")))
           .select(F.col("cluster").alias("u1"), F.least("own", "other").alias("u2"),
                   F.greatest("own", "other").alias("u3"), "doc_id", "n", "items", "copies",
                   F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side")))
    return (small.unionByName(big).groupBy("u1", "u2", "u3")
            .applyInPandas(_verify, "a long, b long, met long"))


# ---------------------------------------------------------------- the operator
def jaccard_links(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of documents (doc_id, text): beside the
    component the number of other documents that a document itself is linked with."""
    return _joined(docs, True)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents (doc_id, text), linked at 0.75.

    component_id is the smallest doc_id reachable through links, the document included.
    """
    return _joined(docs, False)


def _joined(docs: DataFrame, counted: bool) -> DataFrame:
    base = materialize(shared_shingles(docs))
    able = base.filter("shared is not null")
    # equal sets: fully shared with the same shingles; everything else is its own class
    able = able.withColumn("same", F.when(F.size("shared") == F.col("n"), F.md5(
        F.concat_ws(",", F.transform("shared", lambda x: x.cast("string"))))).otherwise(
        F.concat(F.lit("d"), F.col("doc_id"))))
    able = materialize(able)
    # rows with the same doc_id are one member; sizes are only looked at for the number of links
    members = able.select("same", "doc_id").distinct() if counted else able
    classes = members.groupBy("same").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    if counted:
        classes = materialize(classes)
    reps = able.join(classes.withColumnRenamed("same", "of"), (F.col("same") == F.col("of"))
                     & (F.col("doc_id") == F.col("rep")))
    reps = materialize(reps.select("doc_id", "n", "shared", "copies").dropDuplicates(["doc_id"]))
    # exact document frequencies among what can still link
    post = reps.select("doc_id", F.explode("shared").alias("item"))
    df = post.groupBy("item").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = post.join(df, "item").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("df", "item"))).alias("ranked"))
    sets = (reps.select("doc_id", "n", "copies").join(ranked, "doc_id").filter("4 * size(ranked) >= 3 * n")
            .select("doc_id", "n", F.col("ranked.item").alias("items"), "copies"))
    sets = materialize(sets)
    sizes = [(r[0], r[1]) for r in sets.filter("n <= 512").groupBy("n").count().collect()]  # at most 512 rows
    light = boundary(sizes)
    keys = join_keys(sets, light)
    hubs = keys.groupBy("key").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).filter("b < top")
    edges = keys.join(hubs.select("key", "b"), "key").select(F.col("doc_id").alias("a"), "b").distinct()
    clusters = C.connected(edges).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "cluster")
    # the smallest document of a cluster is itself no source of an edge
    clusters = clusters.union(clusters.select(F.col("cluster").alias("doc_id"), "cluster").distinct())
    verified = materialize(verified_links(sets, materialize(clusters)))
    links = verified.filter("a <> b").select("a", "b")
    of_class = able.join(classes.filter("rep is not null"), "same").select("doc_id", "rep").filter("doc_id <> rep")
    found = C.connected(links.union(of_class.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    out = (base.select("doc_id", F.col("n").alias("n_shingles"))
           .join(found, F.col("doc_id") == F.col("node"), "left")
           .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    if not counted:
        return out
    met = verified.filter("a = b").groupBy("a").agg(F.sum("met").alias("met"))
    of_rep = classes.join(met, F.col("rep") == F.col("a"), "left").select(
        "same", (F.col("copies") - 1 + F.coalesce("met", F.lit(0))).alias("n_links")).filter("n_links > 0")
    numbers = members.join(of_rep, "same").groupBy("doc_id").agg(F.max("n_links").alias("n_links"))
    return out.join(numbers, "doc_id", "left").select(*out.columns, F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id; all columns kept.

    Rows that repeat a kept doc_id stay as they are (they are one document to the join).
    A null doc_id cannot be grouped: such rows stay.
    """
    gone = jaccard_components(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(materialize(gone), "doc_id", "left_anti")   # ids only: stored before any text moves
