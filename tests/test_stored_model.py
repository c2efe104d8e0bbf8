"""The month-partitioned, bucketed copy of the model: equal reports, no shuffles, pruned months, replaced months."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import incidence as inc
from shelterlens.plans.params import SPINE
from shelterlens.plans.roles import model_from_driver
from shelterlens.sources import storage

SF = "/root/testdata/sf0.001"
FRAMES = ("animals", "visits", "intake_status", "exam_conditions", "statuses")
DISEASE = inc.DISEASES["diarrhea"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    model = model_from_driver(spark, SF)
    storage.store_model(model, root, 2, FRAMES)
    return root, model, storage.open_model(spark, root)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_stock_joins_without_a_shuffle(spark, stored, no_broadcast):
    _, model, copy = stored
    with storage.co_partitioned(spark):
        got = inc.stock_population(copy, SPINE, DISEASE)
        plan = plan_of(got)
        result = rows(got)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "Exchange" in plan_of(inc.stock_population(model, SPINE, DISEASE))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert result == rows(inc.stock_population(model, SPINE, DISEASE)) and result


def test_numerator_and_flow_are_equal_and_prune_months(spark, stored):
    _, model, copy = stored
    spine = MonthSpine(SPINE.months[20:26])
    for build in (inc.incidence_numerator, inc.flow_population):
        got = build(copy, spine, DISEASE)
        scans = [x for x in plan_of(got).splitlines() if "FileScan" in x and "exam_conditions" in x]
        assert scans and all(re.search(r"PartitionFilters: \[.*stored_month", x) for x in scans)
        assert rows(got) == rows(build(model, spine, DISEASE))


def test_hot_animal_is_read_as_plain_months(spark, tmp_path):
    t0 = dt.datetime(2020, 1, 1)
    data = [(1 if i % 3 == 0 else i, f"s{i % 4}", "A", t0 + dt.timedelta(days=i % 400), i) for i in range(6000)]
    data.append((None, None, None, None, None))
    st = spark.createDataFrame(data, "AnimalID long, Stage string, Status string, LastUpdated timestamp_ntz, "
                                     "OperationPrimaryID long")
    storage.store_model({"statuses": st}, str(tmp_path), 16, ("statuses",))
    copy = storage.open_model(spark, str(tmp_path))["statuses"]
    assert rows(copy.drop(storage.MONTH)) == rows(st)
    assert "Bucketed: true" not in plan_of(copy.groupBy("AnimalID").count())
    some = storage.bounded(copy, "LastUpdated", dt.date(2020, 3, 5), dt.date(2020, 5, 1))
    lo, hi = dt.datetime(2020, 3, 5), dt.datetime(2020, 5, 1)
    assert some.count() == sum(1 for r in data if r[3] and lo <= r[3] < hi)
    assert storage.bounded(copy, "LastUpdated", dt.date(2030, 1, 1)).count() == 0


def test_replaced_months_and_failed_writes(spark, tmp_path, monkeypatch):
    root, t0 = str(tmp_path), dt.datetime(2021, 1, 10)
    schema = "AnimalID long, DateCreated timestamp_ntz"
    old = [(i, t0 + dt.timedelta(days=i)) for i in range(120)] + [(7, None)]
    storage.store_model({"euthanasia": spark.createDataFrame(old, schema)}, root, 4, ("euthanasia",))
    new = [(1000 + i, t0 + dt.timedelta(days=3 * i)) for i in range(40)]

    def fail(*_):
        raise RuntimeError("lost")

    fresh = spark.createDataFrame(new, schema)
    with monkeypatch.context() as m:
        m.setattr(storage, "_publish", fail)
        with pytest.raises(RuntimeError):
            storage.replace_months(spark, root, "euthanasia", fresh, dt.date(2021, 2, 1), dt.date(2021, 4, 1))
    held = storage.open_model(spark, root)["euthanasia"].select("AnimalID", "DateCreated")
    assert sorted(map(tuple, held.collect()), key=repr) == sorted(old, key=repr)
    storage.replace_months(spark, root, "euthanasia", fresh, dt.date(2021, 2, 1), dt.date(2021, 4, 1))
    lo, hi = dt.datetime(2021, 2, 1), dt.datetime(2021, 4, 1)
    want = [r for r in old if r[1] is None or not lo <= r[1] < hi] + [r for r in new if lo <= r[1] < hi]
    held = storage.open_model(spark, root)["euthanasia"].select("AnimalID", "DateCreated")
    assert sorted(map(tuple, held.collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        storage.replace_months(spark, root, "euthanasia", fresh, dt.date(2021, 2, 3))


def test_empty_frames_and_no_copy(spark, tmp_path):
    none = spark.createDataFrame([], "AnimalID long, DateCreated timestamp_ntz")
    storage.store_model({"euthanasia": none}, str(tmp_path / "a"), 4, ("euthanasia",))
    assert storage.open_model(spark, str(tmp_path / "a"))["euthanasia"].count() == 0
    with pytest.raises(FileNotFoundError):
        storage.open_model(spark, str(tmp_path / "b"))


def test_bound_of_another_time_column_keeps_all_months(spark, stored):
    _, _, copy = stored
    exams = copy["exam_conditions"].withColumn("DateTimeDiagnosed", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz"))
    assert storage.bounded(exams, "DateTimeDiagnosed", dt.date(2030, 1, 1)).count() == exams.count()
