"""Report runs: each computes a report for all months of its run and publishes its relations.

One function per report of the original (four disease incidences, kittens, two surgery reports,
stays, wait time, delayed euthanasia, clinic invoices) and ``run_all``. Relations go to
``<root>/<report>/<relation>``, by report month where they have one; see ``sources.publish``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import delayed, incidence, invoices, kitten, stay, surgery, wait
from shelterlens.session import materialize
from shelterlens.sources.model import Model
from shelterlens.sources.publish import Relation, covered_labels, publish
from shelterlens.sources.tables import read_export_csv


def _session(m: Model) -> SparkSession:
    return m["animals"].sparkSession


def run_incidence(m: Model, spine: MonthSpine, as_of: _dt.date, root: str, disease: str = "diarrhea") -> dict:
    """Numerator, denominator and chart rows by month, and the percent table of the trailing months."""
    found = incidence.incidence_report(m, spine, incidence.DISEASES[disease], as_of)
    relations = [Relation("Numerator", found["numerator"], "Referencedate"),
                 Relation("Denominator", found["denominator"], "Referencedate"),
                 Relation("Chart", found["chart"], "Referencedate")]
    if "percent" in found:
        relations.append(Relation("Percent", found["percent"], None, ("Month", "species", "Agegroup")))
    return publish(_session(m), f"{root}/{disease}", relations, covered_labels(spine))


def run_kittens(m: Model, spine: MonthSpine, as_of: _dt.date, root: str,
                cohort_start: _dt.date = kitten.COHORT_START) -> dict:
    """The kitten cohort with its grid, the numerator, and the mortality percent of the trailing months."""
    cohort = materialize(kitten.kitten_cohort(m, spine, as_of, cohort_start))
    filled = materialize(kitten.fill_kitten_grid(cohort))
    return publish(_session(m), f"{root}/kittens", [
        Relation("Denominator", filled), Relation("Numerator", kitten.kitten_numerator(filled)),
        Relation("Percent", kitten.mortality_percent(filled, as_of))])


def run_surgery(m: Model, spine: MonthSpine, as_of: _dt.date, root: str,
                cfg: surgery.SurgeryConfig = surgery.GENERAL, site_groups: Sequence = ()) -> dict:
    """Surgeries, complications, the merged rows and the share table (``cfg``: all surgeries or dental)."""
    found = surgery.surgery_report(m, spine, as_of, cfg, site_groups)
    return publish(_session(m), f"{root}/surgery_{cfg.name}", [
        Relation("Denominator", found["denominator"], "reference_date"),
        Relation("Numerator", found["numerator"], "reference_date"),
        Relation("Merged", found["merged"], "SurgeryMonth"), Relation("Share", found["share"])], covered_labels(spine))


def run_stays(m: Model, spine: MonthSpine, root: str) -> dict:
    """Stays that ended and stays still open, by report date."""
    return publish(_session(m), f"{root}/stays", [
        Relation("Outcomed", stay.los_outcomed(m, spine), "Reportdate", ("animalid", "intakedate")),
        Relation("NotOutcomed", stay.los_not_outcomed(m, spine), "Reportdate", ("animalid", "intakedate"))],
        covered_labels(spine))


def run_wait(m: Model, spine: MonthSpine, as_of: _dt.date, root: str,
             history_start: _dt.date = wait.HISTORY_START) -> dict:
    """Wait rows by report month, the bucket table, and its cuts of the current year and the trailing months."""
    spark = _session(m)
    rows = materialize(wait.surgery_wait(m, spine, spark, history_start))
    buckets = materialize(wait.wait_buckets(rows, as_of))
    cuts = wait.wait_subsets(buckets, as_of)
    return publish(spark, f"{root}/wait", [
        Relation("Wait", rows, "reference_date"), Relation("Buckets", buckets),
        Relation("CurrentYear", cuts["current_year"]), Relation("Trailing", cuts["trailing"])], covered_labels(spine))


def run_delayed(m: Model, spine: MonthSpine, root: str) -> dict:
    """The delayed-euthanasia list by report month."""
    return publish(_session(m), f"{root}/delayed", [
        Relation("Delayed", delayed.delayed_outcome(m, spine), "ReportDate", ("AnimalID", "IntakeDate"))], covered_labels(spine))


def invoices_from_csv(spark: SparkSession, animals_csv: str, invoices_csv: str) -> DataFrame:
    """C16 from the two export files."""
    return invoices.invoice_complications(read_export_csv(spark, animals_csv, invoices.ANIMAL_COLUMNS),
                                          read_export_csv(spark, invoices_csv, invoices.INVOICE_COLUMNS))


def run_invoices(spark: SparkSession, animals_csv: str, invoices_csv: str, as_of: _dt.date, root: str) -> dict:
    """Invoice rows, the numerator and the share table of the clinic's exports."""
    rows = materialize(invoices_from_csv(spark, animals_csv, invoices_csv))
    return publish(spark, f"{root}/invoices", [
        Relation("Denominator", rows), Relation("Numerator", invoices.report_numerator(rows)),
        Relation("Share", invoices.invoice_share(rows, as_of))])


def run_all(m: Model, start_year: int, end_year: int, as_of: _dt.date, root: str, site_groups: Sequence = (),
            exports: tuple[str, str] | None = None) -> dict[str, dict]:
    """All reports of a run; ``exports``: the clinic's two CSV files, if there are any."""
    spine = MonthSpine.for_run(start_year, end_year, as_of)
    done = {d: run_incidence(m, spine, as_of, root, d) for d in incidence.DISEASES}
    done["kittens"] = run_kittens(m, spine, as_of, root)
    for cfg in (surgery.GENERAL, surgery.DENTAL):
        done[f"surgery_{cfg.name}"] = run_surgery(m, spine, as_of, root, cfg, site_groups)
    done["stays"] = run_stays(m, spine, root)
    done["wait"] = run_wait(m, spine, as_of, root)
    done["delayed"] = run_delayed(m, spine, root)
    if exports:
        done["invoices"] = run_invoices(_session(m), *exports, as_of, root)
    return done
