"""Pivot-permutation index against brute force: recall, precision, components, odd rows."""

import math

import numpy as np
import pytest

from shelterlens.llm import pivot_index as P


def brute(rows, threshold=P.THRESHOLD):
    """{vec_id: (links, smallest reachable vec_id)} of rows (vec_id, vector, label) with distinct ids."""
    unit = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, float) / np.abs(np.array(v, float)).max()
        unit[i] = (a / np.linalg.norm(a), label)
    links = {i: [j for j, (w, m) in unit.items() if j != i and m == label and len(w) == len(u) and u @ w >= threshold]
             for i, (u, label) in unit.items()}
    out = {}
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, [])), min((x for x in seen if x is not None), default=None))
    return out


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_links_near_the_threshold(spark):
    """Groups around a centre whose pairs lie on both sides of the threshold, in two labels."""
    rng = np.random.default_rng(3)
    rows = []
    for g in range(40):
        centre = rng.normal(size=32)
        centre /= np.linalg.norm(centre)
        for _ in range(rng.integers(2, 12)):
            step = rng.normal(size=32)
            step /= np.linalg.norm(step)
            rows.append((len(rows), (centre + rng.uniform(0.0, 0.35) * step).astype(np.float32).tolist(), int(g % 2)))
    rows += [(len(rows) + k, rng.normal(size=32).astype(np.float32).tolist(), int(k % 2)) for k in range(600)]
    want = brute(rows)
    got = found(P.near_links(spark.createDataFrame(rows, SCHEMA)))
    asked = sum(n for n, _ in want.values())
    assert asked > 300
    assert all(got[i][0] <= want[i][0] for i in want)           # none below the threshold
    assert sum(n for n, _ in got.values()) >= 0.97 * asked
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.98


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(1, a, 1), (2, a, 1), (3, b, 1), (4, a, 2), (5, a, None), (6, None, 1), (7, [0.0] * 3, 1), (8, [], 1),
            (9, [1.0, None, 3.0], 1), (10, [1.0, nan, 3.0], 1), (11, [inf, 2.0, 3.0], 1), (12, [-1.0, -2.0, -3.0], 1),
            (13, [1e-30, 2e-30, 3e-30], 1), (14, [1.0, 2.0, 3.0, 0.0], 1), (15, [1e30, 2e30, 3e30], 1)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want[1] == (4, 1) and want[14] == (0, 14) and want[5] == (0, 5)
    assert found(P.near_links(vectors)) == want
    # repeated rows are one vector, each is returned; a row without id is returned alone
    more = vectors.union(spark.createDataFrame([(1, a, 1), (1, a, 1), (None, a, 1)], SCHEMA))
    again = P.near_links(more).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in again) == sorted(
        [(False, i) for i, *_ in rows] + [(False, 1)] * 2 + [(True, 0)])
    assert {r.vec_id: (r.n_links, r.component_id) for r in again if r.vec_id} == want
    none = next(r for r in again if r.vec_id is None)
    assert (none.n_links, none.component_id, none.kept) == (0, None, True)


def test_empty_and_clashing_columns(spark):
    empty = P.near_links(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0
    names = ["space", "h1", "h2", "cid", "rep", "copies", "near", "vector", "p", "q", "n", "side", "met", "kept", "u1",
             "n_links", "component_id", "a", "b", "node", "component"]
    rows = spark.createDataFrame([(i, [1.0, float(i // 2)], 0) for i in range(1, 7)], SCHEMA)
    wide = rows.selectExpr("*", *[f"'x{k}' as {c}" for k, c in enumerate(names)])
    assert found(P.near_links(wide)) == found(P.near_links(rows))
    kept = P.keep_one(wide)
    assert kept.columns == wide.columns and kept.first()["space"] == "x0"
    assert {r.vec_id for r in kept.collect()} == {r.vec_id for r in P.near_links(rows).filter("kept").collect()}


def test_blocks_and_hot_classes(spark, monkeypatch):
    """A list that is cut into blocks, and a class that holds a third of all rows, give the same links."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    rows = [(i, (centre + 0.05 * rng.normal(size=16)).astype(np.float32).tolist(), 0) for i in range(60)]
    rows += [(100 + i, centre.astype(np.float32).tolist(), 0) for i in range(40)]
    rows += [(200 + i, rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(30)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(P, "HOT_CLASSES", 10)
    whole = found(P.near_links(vectors))
    monkeypatch.setattr(P, "BLOCK", 7)
    monkeypatch.setattr(P, "PAIRS", 16)
    assert found(P.near_links(vectors)) == whole == brute(rows)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_recall_on_the_given_table(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    # noisy copies of the table's own vectors, so that it holds near pairs
    rng = np.random.default_rng(1)
    rows = [(r.vec_id, list(r.embedding), r.label) for r in vectors.collect()]
    for i, v, label in rows[:200]:
        rows.append((10_000 + i, (np.array(v) + 0.03 * rng.normal(size=len(v))).astype(np.float32).tolist(), label))
    want = brute(rows)
    got = found(P.near_links(spark.createDataFrame(rows, SCHEMA)))
    assert sum(n for n, _ in want.values()) >= 300
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
