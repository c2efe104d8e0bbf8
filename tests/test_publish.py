"""Publishing: reruns replace only changed months, failed runs leave the old output; report runs end to end."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import run
from shelterlens.plans.params import WAIT_HISTORY_START
from shelterlens.plans.roles import exports_from_driver, model_from_driver
from shelterlens.sources import publish as pub
from shelterlens.sources.publish import Relation, covered_labels, manifest, publish, read_published
from shelterlens.sources.sinks import write_table

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(1995, 6, 15)
SPINE = MonthSpine.between(dt.date(1995, 2, 1), dt.date(1995, 5, 1))


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, day date, report string")


ROWS = [(1, dt.date(2024, 1, 5), "a"), (2, dt.date(2024, 1, 6), "b"), (3, dt.date(2024, 2, 1), None), (4, dt.date(2024, 3, 1), "x")]


def published(spark, root, name="N"):
    return sorted((r.report_month, r.id, r.report) for r in read_published(spark, root, name).collect())


def test_rerun_replaces_changed_months_only(spark):
    root = tempfile.mkdtemp(prefix="shelterlens-pub-")
    rel = lambda rows: [Relation("N", frame(spark, rows), "day", ("id",)), Relation("All", frame(spark, rows))]
    assert publish(spark, root, rel(ROWS))["N"] == ["2024-Feb", "2024-Jan", "2024-Mar"]
    first = {r.report_month: r.folder for r in manifest(spark, root) if r.relation == "N"}
    assert publish(spark, root, rel(ROWS)) == {"N": [], "All": []}
    changed = [*ROWS[:2], (3, dt.date(2024, 2, 1), "new"), ROWS[3]]
    assert publish(spark, root, rel(changed)) == {"N": ["2024-Feb"], "All": ["all"]}
    second = {r.report_month: r.folder for r in manifest(spark, root) if r.relation == "N"}
    assert second["2024-Jan"] == first["2024-Jan"] and second["2024-Feb"] != first["2024-Feb"]
    assert ("2024-Feb", 3, "new") in published(spark, root) and len(published(spark, root)) == 4
    # a run of February alone: the other months stay; a covered month without rows goes
    feb = covered_labels([dt.date(2024, 2, 1)])
    assert publish(spark, root, [Relation("N", frame(spark, [(9, dt.date(2024, 2, 2), "z")]), "day")], feb) == {"N": ["2024-Feb"]}
    assert [r[:2] for r in published(spark, root)] == [("2024-Feb", 9), ("2024-Jan", 1), ("2024-Jan", 2), ("2024-Mar", 4)]
    publish(spark, root, [Relation("N", frame(spark, []), "day")], feb)
    assert [r[:2] for r in published(spark, root)] == [("2024-Jan", 1), ("2024-Jan", 2), ("2024-Mar", 4)]
    assert read_published(spark, root, "All").count() == 4
    with pytest.raises(ValueError):
        read_published(spark, root, "nothing")


def test_failed_run_leaves_the_old_output(spark, monkeypatch):
    """Killed between relations, and while the manifest is written: old rows are read; the rerun publishes."""
    root = tempfile.mkdtemp(prefix="shelterlens-pub-")
    publish(spark, root, [Relation("N", frame(spark, ROWS), "day"), Relation("D", frame(spark, ROWS), "day")])
    before = published(spark, root)
    new = [(i, d, "again") for i, d, _ in ROWS]
    bad = frame(spark, new).withColumn("report", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        publish(spark, root, [Relation("N", frame(spark, new), "day"), Relation("D", bad, "day")])
    assert published(spark, root) == before and published(spark, root, "D") == before
    with monkeypatch.context() as patch:
        patch.setattr(pub, "MANIFEST", "relation int")        # the last step fails
        with pytest.raises(Exception):
            publish(spark, root, [Relation("N", frame(spark, new), "day")])
    assert published(spark, root) == before
    publish(spark, root, [Relation("N", frame(spark, new), "day"), Relation("D", frame(spark, new), "day")])
    assert {r[2] for r in published(spark, root)} == {"again"} and len(published(spark, root)) == len(before)


def test_report_runs_publish_what_they_compute(spark):
    root = tempfile.mkdtemp(prefix="shelterlens-run-")
    m = model_from_driver(spark, SF, line_locations=True)
    done = {
        "diarrhea": run.run_incidence(m, SPINE, AS_OF, root), "kittens": run.run_kittens(m, SPINE, AS_OF, root, dt.date(1995, 1, 1)),
        "surgery_all": run.run_surgery(m, SPINE, AS_OF, root), "stays": run.run_stays(m, SPINE, root),
        "wait": run.run_wait(m, SPINE, AS_OF, root, WAIT_HISTORY_START), "delayed": run.run_delayed(m, SPINE, root)}
    from shelterlens.plans import stay
    want = stay.los_not_outcomed(m, SPINE)
    got = read_published(spark, f"{root}/stays", "NotOutcomed").drop("report_month")
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert set(done["stays"]["NotOutcomed"]) <= covered_labels(SPINE)
    assert read_published(spark, f"{root}/diarrhea", "Denominator").count() > 0
    # the same run again writes nothing
    assert run.run_stays(m, SPINE, root) == {"Outcomed": [], "NotOutcomed": []}
    animals, invoices = exports_from_driver(spark, SF)
    write_table(animals, f"{root}/in/animals", fmt="csv")
    write_table(invoices, f"{root}/in/invoices", fmt="csv")
    run.run_invoices(spark, f"{root}/in/animals", f"{root}/in/invoices", dt.date(2001, 12, 15), root)
    from shelterlens.plans import invoices as iv
    want = iv.invoice_complications(animals, invoices)
    got = read_published(spark, f"{root}/invoices", "Denominator").drop("report_month")
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
