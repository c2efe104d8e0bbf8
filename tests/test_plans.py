"""Plan checks: no cartesian products or nested-loop joins, scans pruned and filtered."""
import pytest

from shelterlens.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    from shelterlens.plans import delayed as dl
    from shelterlens.plans.params import SPINE
    from shelterlens.plans.roles import model_from_driver
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        df = dl.delayed_outcome(model_from_driver(spark, SF), SPINE)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert scans, plan
    for ln in scans:
        assert "l_extendedprice" not in ln and "l_quantity" not in ln  # only needed columns are read
    # the return-flag filter reaches the scan of the order lines
    assert any("EqualTo(l_returnflag,R)" in ln for ln in scans), scans


DATED = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
# Reports that read a dated table without a bound on its time, and the rule that asks for it.
UNBOUNDED = {
    "stock_at_month_start": "past intakes have no lower bound (Q5)", "at_risk_population": "past intakes (Q5)",
    "incidence_chart_rows": "past intakes (Q5)", "infection_percent": "past intakes (Q5)",
    "uri_infection_percent": "past intakes (Q5)", "parvo_chart_rows": "past intakes (Q5)",
    "ringworm_chart_rows": "past intakes (Q5)",
    "surgery_dedup": "the first location row of an animal, whenever (Q22)", "complication_min_days": "locations (Q22)",
    "dental_surgeries": "locations (Q22)", "dental_complications": "locations (Q22)",
}
BOUNDED = ["numerator_onset", "flow_without_early_onset", "delayed_outcome", "surgery_rank"]


def dated_scans(spark, df):
    """(scan line, bounded) of the scans that read a time column of a dated table."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        column = next((c for t, c in DATED.items() if f"/{t}.parquet" in line and f"{c}:" in line.split("ReadSchema")[1]), None)
        if column:
            out.append((line, any(f"{op}({column}" in line for op in (
                "GreaterThanOrEqual", "GreaterThan", "LessThanOrEqual", "LessThan"))))
    return out


@pytest.mark.parametrize("name", BOUNDED)
def test_month_bounds_reach_the_scan(spark, name):
    """Dated tables are read between literal bounds, but where a rule has none (births come from the first order)."""
    scans = dated_scans(spark, catalog.queries()[name](spark, SF))
    free = [line for line, bounded in scans if not bounded and "min(" not in line]
    assert scans and sum(bounded for _, bounded in scans) >= len(scans) / 2, free


@pytest.mark.parametrize("name", sorted(UNBOUNDED))
def test_reports_with_open_rules_still_bound_the_rest(spark, name):
    scans = dated_scans(spark, catalog.queries()[name](spark, SF))
    assert not scans or any(bounded for _, bounded in scans), name


def test_minimum_with_ties_is_cut_before_the_shuffle(spark):
    from shelterlens.operators.dedupe import keep_min_ties
    df = spark.range(100).selectExpr("id % 3 as k", "id % 7 as v", "id")
    plan = keep_min_ties(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and plan.count("Range (") == 1


def test_stays_read_few_tables(spark, monkeypatch):
    """Scans over all steps of a stay report, those that it stores included."""
    from shelterlens import session
    from shelterlens.operators import timeline
    from shelterlens.plans import kitten, stay
    plans = []

    def counted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return session.materialize(df)
    monkeypatch.setattr(timeline, "materialize", counted)
    monkeypatch.setattr(stay, "materialize", counted)
    for name in ("stay_with_dwell", "open_stay_with_dwell"):
        plans.clear()
        plans.append(catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
        assert len(plans) > 1 and sum(p.count("FileScan") for p in plans) <= 24, name
    plans.clear()
    monkeypatch.setattr(kitten, "materialize", counted)
    plans.append(catalog.queries()["weekly_presence_cohort"](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and sum(p.count("FileScan") for p in plans) <= 18
    plan = catalog.queries()["complication_min_days"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 14


def test_a_grid_needs_bounded_dimensions(spark):
    from shelterlens.operators.spine import domain, observed_grid, product_of
    df = spark.range(30).selectExpr("id", "id % 3 as g", "cast(null as string) as s")
    assert domain(df, "g") == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 10"):
        observed_grid(df, ["g", "id"], bound=10)
    with pytest.raises(ValueError, match="bound of 50"):
        product_of(spark, {"g": [1, 2], "h": list(range(30))}, {c: df.schema["id"].dataType for c in "gh"}, bound=50)
    grid = observed_grid(df, ["g", "id"])
    assert grid.count() == 90 and "Join" not in grid._jdf.queryExecution().executedPlan().toString()
    assert observed_grid(df, ["g", "s"]).count() == 0
