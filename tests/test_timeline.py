"""Timeline operators against brute force; hot keys; ranges that cut keys anywhere."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelterlens.operators.timeline import Timeline, asof_ranged, cover_counts, islands, next_event_ranged

BASE = dt.datetime(2020, 1, 1)


def ts(rng, days=200):
    return BASE + dt.timedelta(days=rng.randint(0, days), hours=rng.choice([0, 0, 9, 17]))


def hot_key(rng):
    """Every third key is the same one."""
    return 7 if rng.random() < 0.34 else rng.randint(0, 40)


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("ranges", [1, 6, 40])
def test_asof_brute_force(spark, strict, ranges):
    rng = random.Random(ranges)
    left = [(i, hot_key(rng), ts(rng)) for i in range(300)] + [(900, None, BASE), (901, 7, None), (902, 99, BASE)]
    right = [(hot_key(rng), ts(rng), rng.choice("xyz")) for _ in range(300)] + [(None, BASE, "x"), (7, None, "x")]
    got = asof_ranged(spark.createDataFrame(left, "id int, a int, ts timestamp_ntz"),
                      spark.createDataFrame(right, "a int, rts timestamp_ntz, kind string"), ["a"], "ts", "rts", ["kind"],
                      strict, ranges)
    assert got.columns == ["id", "a", "ts", "rts", "kind"]
    rows = {r.id: (r.rts, r.kind) for r in got.collect()}
    assert len(rows) == len(left)
    for i, a, t in left:
        found = [(u, k) for b, u, k in right if a is not None and t is not None and a == b and u is not None
                 and (u < t or (u == t and not strict))]
        assert rows[i] == (max(found) if found else (None, None)), i


def test_next_event_and_totals(spark):
    rng = random.Random(4)
    rows = [(i, hot_key(rng), ts(rng, 60), rng.choice("pq")) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, a int, ts timestamp_ntz, place string")
    got = {r.id: r.days for r in next_event_ranged(df, ["a"], "ts", "days", ["place", "id"], ranges=17).collect()}
    for i, a, t, p in rows:
        later = [(u, q, j) for j, b, u, q in rows if b == a and (u, q, j) > (t, p, i)]
        assert got[i] == ((min(later)[0].date() - t.date()).days if later else None), i
    line = Timeline(df, ["a"], ["ts", "place", "id"], ranges=23).total("s", F.col("id")).last(
        "p", F.when(F.col("place") == "p", F.col("id")))
    for r in line.rows().collect():
        before = [(u, q, j) for j, b, u, q in rows if b == r.a and (u, q, j) <= (r.ts, r.place, r.id)]
        assert r.s == sum(j for *_, j in before)
        of_p = [x for x in before if x[1] == "p"]
        assert r.p == (max(of_p)[2] if of_p else None)


def test_sweep_line_brute_force(spark):
    rng = random.Random(9)
    points = [(i, hot_key(rng), ts(rng)) for i in range(300)] + [(800, None, BASE), (801, 7, None)]
    spans = []
    for j in range(120):
        s = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 190))
        spans.append((j, hot_key(rng), s, s + dt.timedelta(days=rng.choice([0, 0, 1, 5, 60, 11000, -3]))))
    spans += [(500, 7, None, dt.date(2021, 1, 1)), (501, 7, dt.date(2019, 1, 1), None)]
    p = spark.createDataFrame(points, "id int, a int, ts timestamp_ntz")
    iv = spark.createDataFrame(spans, "j int, a int, s date, e date")
    df = cover_counts(p, iv, ["a"], "ts", "s", "e", ranges=13)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan      # no month copies: an interval is two events
    for r in df.collect():
        want = sum(1 for _, a, s, e in spans if a == r.a and r.a is not None and r.ts is not None and s and e
                   and dt.datetime.combine(s, dt.time()) < r.ts < dt.datetime.combine(e, dt.time()))
        assert r.n_intervals == want, r
    joined = {(r.a, r.s, r.e) for r in islands(iv, ["a"], "s", "e").collect()}
    for a in {x[1] for x in spans}:
        days = sorted({(s, e) for _, b, s, e in spans if b == a and s and e and s < e})
        out = []
        for s, e in days:
            if out and s < out[-1][1]:
                out[-1] = (out[-1][0], max(e, out[-1][1]))
            else:
                out.append((s, e))
        assert {x for x in joined if x[0] == a} == {(a, s, e) for s, e in out}


def test_a_third_in_one_key_and_month_splits(spark):
    """A key's month that holds a third of all rows lies in many ranges, none of them above twice the median."""
    rows = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 5, id % 1000) as a", "id",
        "timestamp_ntz'2020-05-01' + make_dt_interval(0, 0, 0, cast(id % 86400 as decimal(18, 6))) as ts")
    line = Timeline(rows, ["a"], ["ts", "id"], ranges=24)
    sizes = sorted(r["count"] for r in line.cut.groupBy("_range").count().collect())
    assert line.cut.select("a").distinct().count() == 1 and line.plain.filter("a = 5").count() == 0
    assert len(sizes) >= 20 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    # as many times as there are, all in the same instant
    same = rows.withColumn("ts", F.expr("timestamp_ntz'2020-05-01'"))
    got = asof_ranged(same.filter("id % 2 = 0"), same.filter("id % 2 = 1").select("a", F.col("ts").alias("rts"), "id"),
                      ["a"], "ts", "rts", [], strict=False, ranges=24)
    assert got.filter("a = 5 and rts is null").count() == 0 and got.filter("a = 5").count() > 9000


def test_ranges_do_not_shuffle_again(spark):
    df = spark.range(1000).selectExpr("0 as a", "id as t")
    line = Timeline(df, ["a"], ["t"], ranges=8).total("s", F.col("t"))
    main = line.cut._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "hashpartitioning" not in main and "shufflepartitionidpassthrough" in main
    assert line.plain.count() == 0 and line.rows().filter("s <> t * (t + 1) / 2").count() == 0


def test_empty(spark):
    none = spark.createDataFrame([], "a int, ts timestamp_ntz, s date, e date")
    assert asof_ranged(none.select("a", "ts"), none.select("a", F.col("ts").alias("r")), ["a"], "ts", "r", []).count() == 0
    assert cover_counts(none.select("a", "ts"), none.select("a", "s", "e"), ["a"], "ts", "s", "e").count() == 0
