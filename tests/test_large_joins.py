"""Joins of tables that grow with the data pass nothing through the driver, however small the data is."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelterlens.operators import joins, temporal
from shelterlens.operators.dedupe import Ord, keep_first
from shelterlens.operators.spine import MonthSpine
from shelterlens.operators.timeline import Timeline
from shelterlens.plans import delayed, incidence, stay, surgery
from shelterlens.plans.roles import model_from_driver_tables

T = dt.datetime


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "nation": spark.createDataFrame([(0, "NATION_0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.createDataFrame([(1, "a", 0, 1.0, "BUILDING"), (2, "b", 0, 1.0, "BUILDING")],
                                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": spark.createDataFrame([(10, 1, "F", 1.0, T(1996, 3, 1), "1-URGENT"), (11, 2, "F", 1.0, T(1996, 3, 2), "1-URGENT")],
                                        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                        "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": spark.createDataFrame([(10, 1, 1, 1, 0.0, 0.05, "R", "F", T(1996, 3, 9)), (11, 1, 1, 1, 0.0, 0.05, "A", "F", T(1996, 3, 9))],
                                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, "
                                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "supplier": spark.createDataFrame([(1, "s", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": spark.createDataFrame([(1, "STANDARD")], "p_partkey long, p_type string"),
        "events": spark.createDataFrame([(1, T(1996, 1, 1), "view")], "user_id long, ts timestamp_ntz, event_type string"),
    }


@pytest.mark.parametrize("build", [
    lambda m, s: incidence.incidence_numerator(m, s, incidence.DISEASES["diarrhea"]),
    lambda m, s: incidence.population_at_risk(m, s, incidence.DISEASES["diarrhea"]),
    lambda m, s: delayed.delayed_outcome(m, s),
], ids=["numerator", "population", "delayed"])
def test_growing_tables_are_not_broadcast(spark, tables, build):
    df = build(model_from_driver_tables(tables), MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    hashed = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all("nationkey" in line for line in hashed), hashed


def test_rows_of_the_small_tables(tables):
    m = model_from_driver_tables(tables)
    spine = MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1))
    rows = incidence.incidence_numerator(m, spine, incidence.DISEASES["diarrhea"]).collect()
    assert [(r.animalid, r.condition, r.intakedate, r.examdate) for r in rows] == [(1, "Diarrhea", T(1996, 3, 1), T(1996, 3, 9))]
    rows = delayed.delayed_outcome(m, spine).collect()
    assert [(r.AnimalID, r.TimetoEuth, r.ReportDate) for r in rows] == [(1, 8, dt.date(1996, 4, 1))]


def test_surgeries_are_shuffled_once(tables):
    rows = surgery.surgeries(model_from_driver_tables(tables), MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1      # the stored treatment rows, by animal and month
    assert [(r.AnimalID, r.SurgeryType, r.Rank) for r in sorted(rows.collect())] == \
        [(1, "Ovariohysterectomy", 1), (2, "Ovariohysterectomy", 1)]


def test_keep_first_sends_no_column_twice(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (1, 3, "a")], "k int, t int, v string")
    first = keep_first(df, ["k"], [Ord("t"), Ord("v")])
    assert [tuple(r) for r in first.collect()] == [(1, 3, "a")]
    assert "_row" not in first._jdf.queryExecution().optimizedPlan().toString()
    last = keep_first(df, ["k"], [Ord("t", asc=False), Ord("v")])
    assert [tuple(r) for r in last.collect()] == [(1, 5, "a")]


def test_timelines_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_A_TASK", 10)
    events = spark.range(95).selectExpr("id % 50 AS k", "id AS t")
    line = Timeline(events, ["k"], ["t"], ranges=4)
    assert line.plain.rdd.getNumPartitions() == 10
    got = {(r.k, r.t): r.n for r in line.next("n", F.col("t")).rows().collect()}
    assert got == {(i % 50, i): i + 50 if i + 50 < 95 else None for i in range(95)}


def left_to_the_planner(df):
    """Shuffles by a hash whose number of tasks is not fixed from the number of rows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "hashpartitioning" in line and "REPARTITION_BY_NUM" not in line]


def test_open_stays_are_dealt_by_their_rows(tables):
    m = model_from_driver_tables(tables, line_locations=True)
    rows = stay.los_not_outcomed(m, MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1)))
    assert left_to_the_planner(rows) == []
    assert rows.collect() == []      # both left before the first report date after their intake
    spine = MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1))
    tables = tables | {"lineitem": tables["lineitem"].withColumn("l_shipdate", F.lit(T(1996, 5, 9)))}
    rows = stay.los_not_outcomed(model_from_driver_tables(tables, line_locations=True), spine)
    assert sorted((r.animalid, r.Reportdate, r.total_los, r.days_in_foster) for r in rows.collect()) == [
        (1, dt.date(1996, 4, 1), 31, 0), (2, dt.date(1996, 4, 1), 30, 0)]


def test_asked_months_are_written_out_where_their_key_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(temporal, "NARROW_ROWS", 10)
    times = spark.range(40).selectExpr("id % 5 AS k", "timestamp_ntz'1996-01-15' + make_interval(0, id) AS t")
    asked = spark.range(5).selectExpr("id AS k", "date'1996-03-01' AS m", "date'1996-12-01' AS u")
    out = temporal.latest_at_month_starts(asked, ["k"], "m", {"last": (times, "t", True)}, 40, "u", 50)
    assert out.rdd.getNumPartitions() == 10
    want = {}
    for k in range(5):
        for month in range(3, 13):
            before = [i for i in range(40) if i % 5 == k and i < month - 1]
            want[k, dt.date(1996, month, 1)] = T(1996, 1 + before[-1], 15) if before else None
    assert {(r.k, r.m): r.last for r in out.collect()} == want


def test_status_rows_are_dealt_by_their_rows(tables, monkeypatch):
    m = model_from_driver_tables(tables)
    monkeypatch.setattr(m, "rows", lambda frame: 2_000_000)   # 21 tasks, over the 8 of the session
    spine = MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1))
    stock = incidence.stock_population(m, spine, incidence.DISEASES["diarrhea"])
    plan = stock._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 4      # visits, spans by (animal, month) and by animal, animals
    assert sorted((r.animalid, r.Referencedate.month, r.stage, r.intakedate) for r in stock.collect()) == [
        (2, month, "Evaluate", T(1996, 3, 2)) for month in range(4, 13)]


def test_intakes_are_not_written_out_into_months(tables):
    m = model_from_driver_tables(tables)
    rows = incidence.incidence_numerator(m, MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1)),
                                         incidence.DISEASES["ringworm"])
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.collect() == []
