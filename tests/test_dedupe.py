import random

from hypothesis import given, settings
from hypothesis import strategies as st

from shelterlens.operators.dedupe import Ord, keep_first, keep_last, keep_min_ties

rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.one_of(st.none(), st.integers(0, 4)),
                          st.sampled_from(["a", "b", "c"])), min_size=1, max_size=40)


def _pandas_first(data, ascending):
    """Reference: sort by (x, y, s) with the given directions, NULLs last, keep the first per k."""
    def key(row):
        out = []
        for v, asc in zip(row[1:], ascending):
            if v is None:
                out.append((1, 0))
            elif isinstance(v, str):
                out.append((0, v) if asc else (0, "".join(chr(255 - ord(ch)) for ch in v)))
            else:
                out.append((0, v if asc else -v))
        return out
    best = {}
    for row in data:
        if row[0] not in best or key(row) < key(best[row[0]]):
            best[row[0]] = row
    return sorted(best.values(), key=str)


@settings(max_examples=25, deadline=None)
@given(rows)
def test_keep_first_matches_sorted_drop_duplicates(spark, data):
    df = spark.createDataFrame(data, "k int, x int, y int, s string")
    for method in ("agg", "window"):
        got = keep_first(df, ["k"], [Ord("x"), Ord("y"), Ord("s")], method=method)
        assert sorted(map(tuple, got.collect()), key=str) == _pandas_first(data, [True, True, True])
    got = keep_first(df, ["k"], [Ord("x", asc=False), Ord("y", asc=False), Ord("s")])
    assert sorted(map(tuple, got.collect()), key=str) == _pandas_first(data, [False, False, True])


def test_keep_last_prefers_last(spark):
    df = spark.createDataFrame([(1, "Comp", 3), (1, "NoComp", 1), (2, "NoComp", 5)], "k int, t string, v int")
    got = {r.k: r.t for r in keep_last(df, ["k"], [Ord("t", asc=False)]).collect()}
    assert got == {1: "Comp", 2: "NoComp"}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=30))
def test_keep_min_ties_keeps_all_minima(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    mins = {}
    for k, v in data:
        mins[k] = min(v, mins.get(k, v))
    want = sorted((k, v) for k, v in data if v == mins[k])
    for method in ("window", "join"):
        assert sorted(map(tuple, keep_min_ties(df, ["k"], "v", method).collect())) == want


def test_keep_first_hot_key_is_aggregate(spark):
    random.seed(1)
    data = [(0 if i % 3 else i, random.randint(0, 1000)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, v int")
    out = keep_first(df, ["k"], [Ord("v")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert "Window" not in plan
    assert dict(map(tuple, out.collect()))[0] == min(v for k, v in data if k == 0)
