"""Row identity beyond small key ranges, and where intermediates may be stored."""
import pytest
from pyspark.sql import functions as F

from shelterlens import session
from shelterlens.operators.temporal import exists_prior_within_days
from shelterlens.plans import incidence as inc
from shelterlens.plans.roles import LINE_ID


def test_line_ids_of_large_keys_stay_distinct_and_sorted(spark):
    rows = [(o, n, p, s) for o in (1, 70_000_000, 7 * 10 ** 12) for n in (1, 2, 7)
            for p in (5, 5 + 1_048_576, 2_000_000) for s in (3, 3 + 16_384, 20_000)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    ids = [r[0] for r in df.orderBy(*df.columns).select(F.expr(LINE_ID)).collect()]
    assert len(set(ids)) == len(rows) and ids == sorted(ids)


class _Fake:
    """A session on a cluster without a shared checkpoint folder."""
    class sparkContext:
        applicationId, master = "app-cluster-test", "spark://host:7077"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Fake)
    assert session.is_local_master("local[4]") and not session.is_local_master("local-cluster[2,1,512]")


@pytest.mark.parametrize("lo,hi", [(0, 200), (3, 100), (2, 365), (0, 3)])
def test_existence_windows_of_any_length(spark, lo, hi):
    import datetime as dt
    import random
    rng = random.Random(hi)
    t0 = dt.datetime(2020, 1, 1)
    make = lambda n: [(rng.randrange(6), t0 + dt.timedelta(hours=rng.randrange(24 * 900))) for _ in range(n)]
    targets, sources = make(150), make(25)
    t = spark.createDataFrame(targets, "k int, t timestamp_ntz")
    s = spark.createDataFrame(sources, "k int, s timestamp_ntz")
    got = sorted(map(tuple, exists_prior_within_days(t, s, ["k"], "t", "s", lo, hi).collect()))
    want = sorted(x for x in targets if any(
        k == x[0] and a < x[1] and lo <= (x[1].date() - a.date()).days <= hi for k, a in sources))
    assert got == want


def test_short_onset_window_equals_brute_force(spark):
    import dataclasses
    from shelterlens.plans.params import SPINE
    from shelterlens.plans.roles import model_from_driver
    m = model_from_driver(spark, "/root/testdata/sf0.001")
    d = dataclasses.replace(inc.DISEASES["diarrhea"], onset_days=(0, 20))
    got = {(r.animalid, r.condition, r.Referencedate): (r.Intaketype, r.intakedate, r.examdate)
           for r in inc.incidence_numerator(m, SPINE, d).collect()}
    exams = inc._listed_exams(m, d, SPINE).collect()
    visits = m["visits"].where(F.col("IntakeType").isin(list(d.intake_types))).collect()
    who = {r.AnimalID for r in inc._cohort_animals(m, d).where("DateOfBirth is not null").collect()}
    want = {}
    for e in exams:
        for v in visits:
            gap = (e.DateCreated.date() - v.tin_DateCreated.date()).days
            if e.AnimalID == v.AnimalID and e.AnimalID in who and v.tin_DateCreated < e.DateCreated and 0 <= gap <= 20:
                k = (e.AnimalID, e.Condition, e.reference_date)
                a, b, c = want.get(k, (v.IntakeType, v.tin_DateCreated, e.DateCreated))
                want[k] = (max(a, v.IntakeType), max(b, v.tin_DateCreated), min(c, e.DateCreated))
    assert got == want and got
