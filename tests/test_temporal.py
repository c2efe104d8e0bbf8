import datetime as dt
import random

from shelterlens.operators.temporal import (asof_backward, asof_backward_bucketed, exists_prior_within_days,
                                            interval_contains_bucketed)


def _rand_ts(rng, base=dt.datetime(2020, 1, 1), days=120):
    return base + dt.timedelta(days=rng.randint(0, days), hours=rng.choice([0, 0, 9, 17]))


def test_exists_prior_within_days_brute_force(spark):
    rng = random.Random(7)
    targets = [(i, rng.randint(0, 4), _rand_ts(rng)) for i in range(200)]
    sources = [(rng.randint(0, 4), _rand_ts(rng)) for _ in range(150)]
    t = spark.createDataFrame(targets, "id int, a int, ts timestamp_ntz")
    s = spark.createDataFrame(sources, "a int, sts timestamp_ntz")
    for lo, hi in ((0, 1), (0, 3), (4, 21)):
        got = {r.id for r in exists_prior_within_days(t, s, ["a"], "ts", "sts", lo, hi).collect()}
        want = {i for i, a, ts in targets
                if any(a2 == a and sts < ts and lo <= (ts.date() - sts.date()).days <= hi for a2, sts in sources)}
        assert got == want, (lo, hi)


def _latest(sources, a, ts, strict):
    cands = [(sts, typ) for a2, sts, typ in sources if a2 == a and (sts < ts if strict else sts <= ts)]
    return max(cands) if cands else (None, None)


def test_asof_backward_variants_brute_force(spark):
    rng = random.Random(11)
    left = [(i, rng.randint(0, 3), _rand_ts(rng, days=400)) for i in range(150)]
    right = [(rng.randint(0, 3), _rand_ts(rng, days=400), rng.choice(["x", "y", "z"])) for _ in range(120)]
    ldf = spark.createDataFrame(left, "id int, a int, ts timestamp_ntz")
    rdf = spark.createDataFrame(right, "a int, rts timestamp_ntz, typ string")
    for strict in (True, False):
        plain = {r.id: (r.rts, r.typ) for r in asof_backward(ldf, rdf, ["a"], "ts", "rts", ["rts", "typ"],
                                                              strict=strict).collect()}
        bucketed = {r.id: (r.rts, r.typ) for r in asof_backward_bucketed(ldf, rdf, ["a"], "ts", "rts", ["typ"],
                                                                          strict=strict).collect()}
        for i, a, ts in left:
            want = _latest(right, a, ts, strict)
            assert plain[i] == want and bucketed[i] == want, (i, strict)


def test_interval_contains_bucketed_brute_force(spark):
    rng = random.Random(3)
    points = [(i, rng.randint(0, 2), _rand_ts(rng, days=700)) for i in range(200)]
    ivs = []
    for j in range(40):
        s = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 600))
        ivs.append((j, rng.randint(0, 2), s, s + dt.timedelta(days=rng.randint(0, 200))))
    p = spark.createDataFrame(points, "pid int, a int, ts timestamp_ntz")
    iv = spark.createDataFrame(ivs, "iid int, a int, s date, e date")
    got = sorted((r.pid, r.iid) for r in interval_contains_bucketed(p, iv, ["a"], "ts", "s", "e").collect())
    want = sorted((pid, iid) for pid, a, ts in points for iid, a2, s, e in ivs
                  if a == a2 and dt.datetime.combine(s, dt.time()) < ts < dt.datetime.combine(e, dt.time()))
    assert got == want


def test_asof_at_month_starts_brute_force(spark):
    from shelterlens.operators.temporal import asof_at_month_starts
    rng = random.Random(5)
    months = [dt.date(2020, m, 1) for m in range(1, 13)]
    left = [(a, m) for a in range(4) for m in months]
    right = [(rng.randint(0, 3), _rand_ts(rng, days=360)) for _ in range(80)]
    right += [(1, dt.datetime(2020, 5, 1)), (2, dt.datetime(2020, 9, 1))]  # exactly at a month start
    ldf = spark.createDataFrame(left, "a int, m date")
    rdf = spark.createDataFrame(right, "a int, ts timestamp_ntz")
    for strict in (True, False):
        got = {(r.a, r.m): r.x for r in asof_at_month_starts(ldf, rdf, ["a"], "m", "ts", "x", strict).collect()}
        for a, m in left:
            start = dt.datetime.combine(m, dt.time())
            cands = [ts for a2, ts in right if a2 == a and (ts < start if strict else ts <= start)]
            assert got[(a, m)] == (max(cands) if cands else None), (a, m, strict)
