"""Surgery wait time (C13, C14): intake-to-surgery days against goals.

Each report month describes surgeries of the month before it (Q26). The intake
is the latest qualifying visit before the exam's last treatment (as-of join per
exam, Q24). The stage attached is the highest listed stage seen before the
report date, with its first date: a per-(animal, stage) minimum, not a join of
every surgery with every status row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, day_diff, month_start, week_diff
from shelterlens.functions.predicates import case_map, collation_of, flag, ne_sql, rank_code
from shelterlens.operators.dedupe import Ord, keep_first
from shelterlens.operators.joins import deal, join_large
from shelterlens.operators.spine import MonthSpine, _add_months, current_year, domain, product_of, trailing_months
from shelterlens.operators.timeline import asof_ranged
from shelterlens.session import materialize
from shelterlens.sources.model import Model

# Fixed values of the wait-time report.
SURGERY_MAP = (
    ("Orchidectomy, cryptorchid", "Neuter"), ("Orchidectomy", "Neuter"), ("Ovariohysterectomy", "Spay"),
    ("Dental Extraction", "Dental"), ("Dental COHAT (Lv 1-3)", "Dental"), ("Dental COHAT (Lv 4-5)", "Dental"),
    ("COHAT", "Dental"), ("Dental Extraction, Difficult", "Dental"), ("Dental Dehiscence Repair", "Dental"))
GOALS = {"Spay": 8, "Neuter": 7, "Dental": 14}
WAIT_SPECIES = ("Cat", "Dog", "Rabbit")
WAIT_STAGES = ("Evaluate", "Post -Op", "Surgery Needed")
EXCLUDED_STAGE = "Surgery Needed"
INTAKE_TYPES = ("OwnerSurrender", "TransferIn", "Stray", "[Return]")
HISTORY_START = _dt.date(2019, 1, 1)
MIN_INTAKE_AGE_WEEKS = 7


def surgery_category(medication: str) -> F.Column:
    """S3: the treatment -> category map (9 fixed entries) as a CASE, which follows the column's collation;
    null for other treatments."""
    return case_map(medication, dict(SURGERY_MAP))


def goal(category) -> F.Column:
    c = F.col(category) if isinstance(category, str) else category
    expr = None
    for k, v in GOALS.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def _of_animals(df: DataFrame, listed: DataFrame) -> DataFrame:
    return join_large(df, listed.select("AnimalID").distinct(), "AnimalID", "left_semi")


def _intake_of_exam(et: DataFrame, surgeries: DataFrame, visits: DataFrame) -> DataFrame:
    """(ExamID, tin_DateCreated, IntakeType): the latest visit before the last treatment time of each of the
    exam's animals, and of those the latest (one row per exam, Q24)."""
    exam_last = materialize(join_large(et, surgeries.select("ExamID").distinct(), "ExamID", "left_semi")
                            .groupBy("ExamID", "AnimalID").agg(F.max("StatusDateTime").alias("_exam_ts")))
    found = asof_ranged(exam_last, _of_animals(visits, exam_last), ["AnimalID"], "_exam_ts", "tin_DateCreated", ["IntakeType"])
    return (found.where(F.col("tin_DateCreated").isNotNull()).groupBy("ExamID")
            .agg(F.max(F.struct("tin_DateCreated", "IntakeType")).alias("_v")).select("ExamID", "_v.*"))


def _intake_of_treatment(surgeries: DataFrame, visits: DataFrame) -> DataFrame:
    """(AnimalID, StatusDateTime, tin_DateCreated, IntakeType): the latest visit before each surgery's own time."""
    moments = surgeries.select("AnimalID", "StatusDateTime").distinct()
    found = asof_ranged(moments, _of_animals(visits, moments), ["AnimalID"], "StatusDateTime", "tin_DateCreated", ["IntakeType"])
    return found.where(F.col("tin_DateCreated").isNotNull())


def surgery_wait(m: Model, spine: MonthSpine, spark: SparkSession,
                 history_start: _dt.date = HISTORY_START, per_treatment: bool = False) -> DataFrame:
    """One row per (animal, surgery category, report month).

    ``per_treatment`` repairs Q24: each surgery gets the latest intake before its own time, not the one
    its exam got. The surgeries are written once, as four steps start from them.
    """
    hs = as_timestamp(F.lit(history_start))
    et = m["treatments"].select("ExamID", "AnimalID", "Medication", "StatusDateTime")
    # surgeries of the months before the report months: literal bounds, so they reach the scan
    surgeries = materialize(et.where(
        F.col("Medication").isin([k for k, _ in SURGERY_MAP])
        & (F.col("StatusDateTime") >= as_timestamp(F.lit(_add_months(spine.first, -1))))
        & (F.col("StatusDateTime") < as_timestamp(F.lit(spine.last)))))
    visits = (m["visits"].where(F.col("IntakeType").isin(list(INTAKE_TYPES)) & (F.col("tin_DateCreated") >= hs))
              .select("AnimalID", "tin_DateCreated", "IntakeType"))
    s = (surgeries.withColumn("reference_date", F.add_months(month_start("StatusDateTime"), 1))
         .where(spine.in_spine("reference_date"))
         .withColumn("Surgerycategory", surgery_category("Medication")))
    if per_treatment:
        s = join_large(s, _intake_of_treatment(surgeries, visits), ["AnimalID", "StatusDateTime"])
    else:
        s = join_large(s, _intake_of_exam(et, surgeries, visits), "ExamID")
    animals = (m["animals"].where(F.col("has_details") & F.col("Species").isin(list(WAIT_SPECIES)))
               .select("AnimalID", "Name", "Species", "DateOfBirth"))
    s = join_large(deal(s, ["AnimalID"], surgeries.count()), animals, "AnimalID")
    # Highest listed stage (other than the excluded one) seen in [history_start, report date): first date per stage.
    st = m["statuses"].where(F.col("Stage").isin(list(WAIT_STAGES)) & ne_sql("Stage", EXCLUDED_STAGE)
                             & (F.col("LastUpdated") >= hs) & (F.col("LastUpdated") < as_timestamp(F.lit(spine.last))))
    st = (_of_animals(st, surgeries)
          .groupBy("AnimalID", "Stage").agg(F.min("LastUpdated").alias("StageDate")))
    s = join_large(s, st, "AnimalID").where(F.col("StageDate") < as_timestamp("reference_date"))
    s = s.select(
        "AnimalID", "Name", "Species", F.col("DateOfBirth").alias("DateofBirth"),
        F.col("tin_DateCreated").alias("IntakeDate"), "IntakeType", "Medication", "Surgerycategory",
        F.col("StatusDateTime").alias("SurgeryDate"), "Stage", "StageDate", "ExamID",
        week_diff("DateOfBirth", "tin_DateCreated").alias("IntakeAge"),
        day_diff("tin_DateCreated", "StatusDateTime").alias("SurgeryWait"), "reference_date")
    s = s.where(F.col("IntakeAge") >= MIN_INTAKE_AGE_WEEKS)
    # stage descending as its rank in the fixed stage list (binary text order), so the
    # keep-first stays a combining aggregate instead of a row_number window
    s = s.withColumn("_stage_rank", rank_code("Stage", WAIT_STAGES, collation_of(st, "Stage")))
    one = keep_first(s, ["AnimalID", "Surgerycategory", "reference_date"],
                     [Ord("_stage_rank", asc=False), Ord("SurgeryDate"), Ord("ExamID"), Ord("Medication"),
                      Ord("StageDate"), Ord("IntakeDate"), Ord("IntakeType"), Ord("Stage")])
    return (one.drop("ExamID", "_stage_rank").withColumn("Agegroup", F.lit("7 wks+"))
            .withColumn("Sx_goal", goal("Surgerycategory")))


def wait_buckets(wait: DataFrame, as_of: _dt.date, only_missing: bool = False) -> DataFrame:
    """C14: month grid rows (every month start from the first surgery to ``as_of``
    x observed category x observed species, Q9; ``only_missing``: only of months without such a
    surgery), bucket flags and goals."""
    rows = wait.withColumn("SurgeryDate", F.to_date("SurgeryDate"))
    first = rows.agg(F.min("SurgeryDate")).first()[0]
    months = [] if first is None or first > as_of else [d for d in MonthSpine.between(first, as_of).months if d >= first]
    domains = {"SurgeryDate": months, "Surgerycategory": domain(rows, "Surgerycategory"), "Species": domain(rows, "Species")}
    grid = product_of(rows.sparkSession, domains, {c: rows.schema[c].dataType for c in domains})
    if only_missing:
        held = rows.select(month_start("SurgeryDate").alias("SurgeryDate"), "Surgerycategory", "Species").distinct()
        grid = grid.join(held, ["SurgeryDate", "Surgerycategory", "Species"], "left_anti")
    out = rows.unionByName(grid, allowMissingColumns=True)
    w = F.col("SurgeryWait")
    return (out.withColumn("<10", flag(w < 10)).withColumn("10-20", flag((w >= 10) & (w <= 20)))
            .withColumn(">20", flag(w > 20)).withColumn("Sx_goal", goal("Surgerycategory")))


def wait_subsets(buckets: DataFrame, as_of: _dt.date) -> dict[str, DataFrame]:
    """P12 and P11 cuts of the wait table."""
    ts = as_timestamp("SurgeryDate")
    return {"current_year": current_year(buckets, ts, as_of), "trailing": trailing_months(buckets, ts, as_of, 13)}
