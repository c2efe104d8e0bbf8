"""Kitten mortality.

Per report month: kittens (0-20 Sunday-weeks old) present at one of five week
starts and not dead before it ("alive" rows), plus kittens that died or were
euthanised in the month ("deceased" rows), one row per (animal, age band) with
deceased preferred; then a month x band x outcome grid and the deceased percent.

Scale notes: a visit can only give alive rows in the ~5 months after birth, so
visits explode into a bounded set of months; the correlated ``NOT IN`` (dead
before the week start) becomes the earliest death date per (animal, month), a running
minimum over the animal's months - no visit x death pairs. Visits and euthanasia
records are read once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, month_end_midnight, month_start, week_diff
from shelterlens.operators.dedupe import Ord, keep_first
from shelterlens.operators.spine import MonthSpine, explode_months, months_between_cols, trailing_months
from shelterlens.session import materialize
from shelterlens.sources.model import Model

# Fixed values of the kitten report.
INTAKE_TYPES = ("TransferIn", "Stray", "[Return]", "OwnerSurrender")
DEAD_OUTCOMES = ("Died", "PreEuthanasia")
WEEK_OFFSETS = (0, 7, 14, 21, 27)
AGE_BANDS = (("0-2 wks", 0, 2), ("3-6 wks", 3, 6), ("7-12 wks", 7, 12), ("13-20 wks", 13, 20))
FILL_OUTCOMES = ("Alive", "Died", "Euthanised")
COHORT_START = _dt.date(2017, 1, 1)
MAX_WEEKS = 20
CATEGORIES = (("0-2 wks", ("0-2 wks",)), ("3-12 wks", ("7-12 wks", "3-6 wks")))


def age_band(weeks: Column) -> Column:
    expr = None
    for label, lo, hi in AGE_BANDS:
        cond = weeks.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def _first_report_month(ts: str) -> Column:
    """First report month whose window ``[.., 00:00 of its last day]`` holds ``ts``."""
    ms = month_start(ts)
    return F.when(F.col(ts) <= month_end_midnight(ms), ms).otherwise(F.add_months(ms, 1))


def _earliest_death_until(keys: DataFrame, a_rows: DataFrame) -> DataFrame:
    """(AnimalID, reference_date, _a_min): the earliest death of source (a) that the report of a month
    knows (first report month ``_b`` at or before it).

    Deaths are folded to one row per (animal, month) and read as a running minimum over the animal's
    months, so the window holds months, not visits.
    """
    known = a_rows.groupBy("AnimalID", F.col("_b").alias("reference_date")).agg(F.min("_od").alias("_od"))
    line = (keys.withColumn("_asked", F.lit(True)).unionByName(known, allowMissingColumns=True)
            .groupBy("AnimalID", "reference_date").agg(F.min("_od").alias("_od"), F.max("_asked").alias("_asked")))
    until = Window.partitionBy("AnimalID").orderBy("reference_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (line.withColumn("_a_min", F.min("_od").over(until)).where("_asked")
            .select("AnimalID", "reference_date", "_a_min"))


def kitten_cohort(m: Model, spine: MonthSpine, now: _dt.date, cohort_start: _dt.date = COHORT_START,
                  week_offsets=WEEK_OFFSETS, open_stays: bool = False) -> DataFrame:
    """Alive and deceased kitten rows per report month (one per animal and band).

    The cohort's visits and its young euthanasia records are written once; per animal they are folded
    into one state row (first dead visit, first euthanasia, best visit). ``open_stays`` repairs Q12: a visit
    without an out date is present at every week start after it.
    """
    start = as_timestamp(F.lit(cohort_start))
    cats = (m["animals"].where((F.col("Species") == "Cat") & F.col("has_details"))
            .select("AnimalID", "Name", "DateOfBirth"))
    v = materialize(m["visits_out"].where(F.col("IntakeType").isin(list(INTAKE_TYPES)) & (F.col("tin_DateCreated") >= start))
                    .join(cats, "AnimalID", "inner")
                    .select("AnimalID", "Name", "DateOfBirth", "IntakeType", "OutComeType", "tin_DateCreated",
                            "tOut_DateCreated", _first_report_month("tin_DateCreated").alias("_b")))
    dob = F.to_date("DateOfBirth")
    died = F.col("OutComeType").isin(list(DEAD_OUTCOMES))
    # source (b) looks at visits before now
    seen = F.col("DateOfBirth").isNotNull() & (F.col("tin_DateCreated") < as_timestamp(F.lit(now)))

    # deceased source (a): dead outcomes of visits; source (b): euthanasia records
    a_rows = (v.where(died & F.col("DateOfBirth").isNotNull())
              .select("AnimalID", "Name", "IntakeType", dob.alias("Dateofbirth"),
                      F.to_date("tin_DateCreated").alias("Intakedate"), "_b",
                      F.when(F.col("OutComeType") == "PreEuthanasia", F.lit("Euthanised"))
                      .when(F.col("OutComeType") == "Died", F.lit("Died")).alias("Outcometype"),
                      F.to_date("tOut_DateCreated").alias("_od"))
              .where(week_diff("Dateofbirth", "_od") <= MAX_WEEKS))
    known = v.where(seen).groupBy("AnimalID", "Name", "DateOfBirth").agg(F.lit(1).alias("_one")).drop("_one")
    eu = materialize(m["euthanasia"].join(known, "AnimalID", "inner")
                     .select("AnimalID", "Name", dob.alias("Dateofbirth"), F.to_date("DateCreated").alias("_od"))
                     .where(week_diff("Dateofbirth", "_od") <= MAX_WEEKS))
    best = F.struct((-F.unix_date(F.to_date("tin_DateCreated"))).alias("k"), F.col("IntakeType").alias("t"),
                    F.to_date("tin_DateCreated").alias("d"))
    state = (v.select("AnimalID", F.when(died, F.col("_b")).alias("_b"), F.when(seen, best).alias("_bv"))
             .unionByName(eu.select("AnimalID", "_od"), allowMissingColumns=True)
             .groupBy("AnimalID").agg(F.min("_b").alias("_first_a"), F.min("_od").alias("_b_min"), F.min("_bv").alias("_bv")))
    no_a_until = F.col("_first_a").isNull() | (F.col("_first_a") > F.col("reference_date"))

    # alive candidates: visits x report months (bounded by the 20-week age window) x week starts
    left = F.lit(True) if open_stays else F.col("tOut_DateCreated").isNotNull()
    d = (v.where(left & F.col("DateOfBirth").isNotNull())
         .withColumn("IntakeAge", week_diff("DateOfBirth", "tin_DateCreated"))
         .where(F.col("IntakeAge").between(0, MAX_WEEKS)))
    last_month = F.least(month_start("tOut_DateCreated"), month_start(F.date_add(dob, 7 * MAX_WEEKS + 6)))
    d = explode_months(d, F.col("_b"), last_month, spine)
    d = (d.withColumn("_ws", F.explode(F.array(*[F.date_add("reference_date", k) for k in week_offsets])))
         .withColumn("_age", week_diff(dob, "_ws"))
         .where(F.col("_age").between(0, MAX_WEEKS) & (F.to_date("tin_DateCreated") <= F.col("_ws"))
                & (F.col("tOut_DateCreated").isNull() | (week_diff("_ws", "tOut_DateCreated") >= 0))))
    keys = d.select("AnimalID", "reference_date").distinct()
    dead = (_earliest_death_until(keys, a_rows).join(state, "AnimalID", "inner")
            .select("AnimalID", "reference_date",
                    F.least(F.col("_a_min"), F.when(no_a_until, F.col("_b_min"))).alias("_dead")))
    alive = (d.join(dead, ["AnimalID", "reference_date"], "left")
             .where(F.col("_dead").isNull() | (F.col("_dead") >= F.col("_ws")))
             .select("AnimalID", "Name", "IntakeType", dob.alias("Dateofbirth"),
                     F.to_date("tin_DateCreated").alias("Intakedate"), "IntakeAge",
                     F.col("reference_date").alias("ReferenceDate"), F.lit("Alive").alias("Outcometype"),
                     age_band(F.col("_age")).alias("Agegroup"), "reference_date"))

    # deceased rows of the month
    dec_a = (a_rows.withColumn("reference_date", month_start("_od"))
             .where(spine.in_spine("reference_date") & (F.col("_b") <= F.col("reference_date")))
             .select("AnimalID", "Name", "IntakeType", "Dateofbirth", "Intakedate",
                     week_diff("Dateofbirth", "Intakedate").alias("IntakeAge"), F.col("_od").alias("ReferenceDate"),
                     "Outcometype", age_band(week_diff("Dateofbirth", "_od")).alias("Agegroup"), "reference_date"))
    dec_b = (eu.withColumn("reference_date", month_start("_od")).where(spine.in_spine("reference_date"))
             .join(state, "AnimalID", "inner").where(no_a_until)
             .select("AnimalID", "Name", F.col("_bv.t").alias("IntakeType"), "Dateofbirth",
                     F.col("_bv.d").alias("Intakedate"), week_diff("Dateofbirth", F.col("_bv.d")).alias("IntakeAge"),
                     F.col("_od").alias("ReferenceDate"), F.lit("Euthanised").alias("Outcometype"),
                     age_band(week_diff("Dateofbirth", "_od")).alias("Agegroup"), "reference_date"))
    rows = (alive.unionByName(dec_a).unionByName(dec_b)
            .withColumn("_is_alive", F.col("Outcometype") == "Alive")
            .withColumnRenamed("AnimalID", "Animalid"))
    one = keep_first(rows, ["Animalid", "Agegroup", "reference_date"],
                     [Ord("_is_alive"), Ord("ReferenceDate", asc=False), Ord("Intakedate", asc=False),
                      Ord("Outcometype"), Ord("IntakeType"), Ord("IntakeAge"), Ord("Name"), Ord("Dateofbirth")])
    return one.drop("_is_alive").withColumn("IntakeAge", F.col("IntakeAge").cast("bigint"))


def fill_kitten_grid(cohort: DataFrame, only_missing: bool = False) -> DataFrame:
    """G2 as the report does it (Q9): every month start between the first and last
    ReferenceDate x every band x every outcome is added with no animal;
    ``only_missing`` adds only the cells whose month has no row."""
    dom = cohort.agg(F.min("ReferenceDate").alias("_lo"), F.max("ReferenceDate").alias("_hi"))
    first = F.when(F.trunc("_lo", "MM") == F.col("_lo"), F.col("_lo")).otherwise(F.add_months(F.trunc("_lo", "MM"), 1))
    grid = (dom.select(F.explode(months_between_cols(first, F.col("_hi"))).alias("ReferenceDate"))
            .select("ReferenceDate", F.explode(F.array(*[F.lit(b[0]) for b in AGE_BANDS])).alias("Agegroup"))
            .select("ReferenceDate", "Agegroup", F.explode(F.array(*[F.lit(o) for o in FILL_OUTCOMES]))
                    .alias("Outcometype")))
    if only_missing:
        held = cohort.select(month_start("ReferenceDate").alias("ReferenceDate"), "Agegroup", "Outcometype").distinct()
        grid = grid.join(held, ["ReferenceDate", "Agegroup", "Outcometype"], "left_anti")
    return cohort.unionByName(grid, allowMissingColumns=True)


def mortality_percent(filled: DataFrame, as_of: _dt.date) -> DataFrame:
    """C6 after P11: deceased / (deceased + alive) x 100 per month for 0-2 and 3-12 weeks."""
    recent = trailing_months(filled, as_timestamp("ReferenceDate"), as_of, 13)
    w = F.when(F.col("Animalid").isNull(), F.lit(0)).otherwise(F.lit(1))
    cat = None
    for label, bands in CATEGORIES:
        cond = F.col("Agegroup").isin(list(bands))
        cat = F.when(cond, F.lit(label)) if cat is None else cat.when(cond, F.lit(label))
    d = recent.select(month_start("ReferenceDate").alias("Month"), cat.alias("AgeGroupCategory"),
                      (F.col("Outcometype") == "Alive").alias("_alive"), w.alias("_w")).where(
        F.col("AgeGroupCategory").isNotNull())
    g = d.groupBy("Month", "AgeGroupCategory").agg(
        F.sum(F.when(~F.col("_alive"), F.col("_w")).otherwise(0)).alias("_dec"),
        F.sum(F.when(F.col("_alive"), F.col("_w")).otherwise(0)).alias("_alv"))
    pct = F.coalesce(F.try_divide(F.col("_dec").cast("double"), (F.col("_dec") + F.col("_alv")).cast("double")),
                     F.lit(0.0)) * 100
    return g.select("Month", F.round(pct, 2).alias("deceased_pct"), "AgeGroupCategory")


def kitten_numerator(filled: DataFrame) -> DataFrame:
    """C17: the report's numerator sheet - deceased rows, grid rows included (Q23)."""
    return filled.where(F.col("Outcometype").isin("Died", "Euthanised"))
