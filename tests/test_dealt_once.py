"""Reports deal their rows once, by animal, and store them narrow: what they shuffle and write stays near what they read."""
import datetime as dt

import pytest
from shelterlens.operators import joins, temporal
from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import stay, surgery
from shelterlens.plans.roles import model_from_driver_tables
from shelterlens.session import materialize_dealt

T = dt.datetime
SPINE = MonthSpine.between(dt.date(1996, 1, 1), dt.date(1996, 12, 1))


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.fixture(scope="module")
def tables(spark):
    """Three animals with surgeries of several kinds and complications over some months (none of the third animal); one line comes twice."""
    orders = [(10 * a + o, a, "F", 1.0, T(1996, 1 + 2 * o, 3 + a), "1-URGENT") for a in (1, 2, 3) for o in range(3)]
    lines = [(k, part, 1 + part % 2, n, 0.06, 0.01 * n, "R" if k >= 30 else "A" if n % 2 else "N", "F", day + dt.timedelta(days=5 * n + part))
             for k, _, _, _, day, _ in orders for n, part in enumerate((1, 2, 3, 4, 1))]
    return {
        "nation": spark.createDataFrame([(0, "NATION_0", 0), (1, "NATION_1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.createDataFrame([(a, f"animal {a}", a % 2, 1.0, "MACHINERY") for a in (1, 2, 3)],
                                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                                "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": spark.createDataFrame(lines + lines[:1], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                                             "l_discount double, l_tax double, l_returnflag string, "
                                                             "l_linestatus string, l_shipdate timestamp_ntz"),
        "supplier": spark.createDataFrame([(1, "s", 0, 1.0), (2, "t", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": spark.createDataFrame([(1, "STANDARD"), (2, "MEDIUM"), (3, "LARGE"), (4, "ECONOMY")], "p_partkey long, p_type string"),
        "events": spark.createDataFrame([(1, T(1996, 1, 1), "view"), (2, T(1996, 1, 1), "error"), (2, T(1996, 1, 2), "click")],
                                        "user_id long, ts timestamp_ntz, event_type string"),
    }


def rows(df):
    return sorted(map(str, df.collect()))


def test_merged_surgeries_are_not_shuffled_after_they_are_stored(tables, monkeypatch):
    merged = surgery.merged_report(model_from_driver_tables(tables), SPINE)
    assert shuffles(merged) == 0
    found = rows(merged)
    assert {"Type='Comp'" in r for r in found} == {True, False}
    monkeypatch.setattr(surgery, "ROWS_A_TASK", 10)      # several tasks
    several = surgery.merged_report(model_from_driver_tables(tables), SPINE)
    assert shuffles(several) == 0 and rows(several) == found
    monkeypatch.setattr(joins, "CROWDED", 0)             # each animal is too much for a task: dealt by its months too
    assert rows(surgery.merged_report(model_from_driver_tables(tables), SPINE)) == found


def test_treatments_are_stored_without_ids_of_text_and_animals(tables, monkeypatch):
    stored = []
    plain = surgery.materialize
    monkeypatch.setattr(surgery, "materialize", lambda df: stored.append(df.columns) or plain(df))
    dedup = surgery.surgeries(model_from_driver_tables(tables), SPINE)
    assert shuffles(dedup) == 1
    assert len(stored) == 1 and not {"ExamTreatmentID", "AssistantName", "Name", "Species", "Location"} & set(stored[0])
    found = {(r.AnimalID, r.UniqueSurgeryID, r.Name, r.Location, r.SurgeonName, r.AssistantName) for r in dedup.collect()}
    ids = "-".join(f"{k:019d}" for k in (10, 0, 1, 2))
    assert (1, ids, "animal 1", "Fosters", "t 1", "t 1") in found
    assert {r[3] for r in found if r[0] == 2} == {"Kennel"} and {r[3] for r in found if r[0] == 3} == {None}
    monkeypatch.setattr(joins, "CROWDED", 0)
    again = surgery.surgeries(model_from_driver_tables(tables), SPINE)
    assert rows(again) == rows(dedup)


def test_join_in_place(spark):
    left = spark.range(60).selectExpr("id % 7 AS k", "if(id % 5 = 0, null, id % 5) AS m", "id AS v")
    right = spark.range(40).selectExpr("id % 9 AS k", "id % 4 AS m", "id AS w")
    held = [materialize_dealt(df.repartition(3, "k"), ["k"], 3) for df in (left, right)]
    out = joins.join_in_place(*held, ["k"], ["m"])
    assert out.columns == ["k", "m", "v", "w"] and shuffles(out) == 0
    assert rows(out) == rows(left.join(right, ["k", "m"]).select("k", "m", "v", "w"))
    both = joins.join_in_place(*held, ["k"], ["m"], "left")
    assert rows(both) == rows(left.join(right, ["k", "m"], "left").select("k", "m", "v", "w"))


def test_a_hot_key_crowds_its_task(spark):
    even = spark.range(100).selectExpr("id AS k")
    hot = spark.range(100).selectExpr("if(id < 60, 1, id) AS k")
    assert not joins.crowded([even], ["k"], 10, 10) and joins.crowded([even, hot], ["k"], 10, 10)
    assert not joins.crowded([even.where("k < 0")], ["k"], 10, 10)


def test_open_stays_are_dealt_once(tables, monkeypatch):
    late = tables | {"lineitem": tables["lineitem"].selectExpr("* except (l_shipdate)", "l_shipdate + interval 40 days AS l_shipdate")}

    def report():
        return stay.los_not_outcomed(model_from_driver_tables(late, line_locations=True), SPINE)
    first = report()
    assert shuffles(first) == 1          # the location rows; stays and windows lie where their animal is
    found = rows(first)
    assert len(found) > 10 and any(r.days_in_foster for r in first.collect())
    monkeypatch.setattr(stay, "NARROW_ROWS", 10)         # several tasks
    several = report()
    assert shuffles(several) == 1 and rows(several) == found
    monkeypatch.setattr(joins, "CROWDED", 0)             # each animal is too much for a task
    spread = report()
    assert shuffles(spread) > 1 and rows(spread) == found


def test_latest_at_month_starts_folds_where_the_key_is_dealt(spark):
    times = spark.range(40).selectExpr("id % 5 AS k", "timestamp_ntz'1996-01-15' + make_interval(0, id) AS t")
    firsts = spark.range(30).selectExpr("id % 5 AS k", "timestamp_ntz'1996-01-01' + make_interval(0, id) AS u")
    asked = spark.range(5).selectExpr("id AS k", "date'1996-03-01' AS m", "date'1996-12-01' AS until")
    sources = {"last": (times, "t", True), "at": (firsts, "u", False)}
    dealt, folded = (temporal.latest_at_month_starts(asked, ["k"], "m", sources, 70, "until", 50, tasks) for tasks in (3, None))
    assert shuffles(dealt) == 1 < shuffles(folded) and dealt.rdd.getNumPartitions() == 3
    assert dealt.count() == 50 and rows(dealt) == rows(folded)
