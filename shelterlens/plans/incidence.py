"""Incidence reports (C1-C4): in-shelter infections over the population at risk.

All report months are computed in one plan. Each fact row is given the months it
can count in with a bounded explode (at most 13 per row), and every "exam after
an intake" rule is answered with combining aggregates and equi-joins against
one-row-per-group tables, so the work stays linear even when one animal holds a
large share of the rows (no pair of exam x visit is ever materialised).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelterlens.functions.dates import (as_timestamp, first_month_start_on_or_after,
                                         last_month_start_before, month_end_midnight, month_start,
                                         week_diff)
from shelterlens.functions.predicates import collation_of, isin_or_null, rank_code, rank_decode
from shelterlens.operators.joins import deal, join_large
from shelterlens.operators.spine import (MonthSpine, _add_months, explode_months, fill_missing_months,
                                         trailing_months)
from shelterlens.operators.temporal import exists_prior_within_days
from shelterlens.session import materialize
from shelterlens.sources.storage import bounded
from shelterlens.sources.model import Model, known_rows

# Fixed values of the incidence reports.
INTAKE_TYPES = ("TransferIn", "Stray", "[Return]", "OwnerSurrender")
SPECIES = ("Cat", "Dog")
STOCK_STAGES = ("Released", "Pre-Euthanasia", "Foster Program", "Evaluate", "Stray Holding - Feline",
                "Stray Holding - Canine", "Pre-Intake", "Surgery Needed", "Pending Behavior Assessment",
                "Bite Quarantine", "Medical Observation", "Foster Needed", "Medical Treatment",
                "Behavior Observation")
FILL_GRID = ({"species": "Dog", "Agegroup": "Adult"}, {"species": "Dog", "Agegroup": "Puppy"},
             {"species": "Cat", "Agegroup": "Adult"}, {"species": "Cat", "Agegroup": "Kitten"})


@dataclass(frozen=True)
class Disease:
    """Parameters of one incidence report."""
    name: str
    conditions: tuple
    onset_days: tuple          # numerator: days after intake, inclusive
    early_days: tuple          # flow exclusion: days after intake, inclusive
    gap_fill: bool = True
    weighted: bool = True
    intake_types: tuple = INTAKE_TYPES
    species: tuple = SPECIES
    stages: tuple = STOCK_STAGES
    closed_month: bool = False   # repair of Q3: the last day of the month counts as a whole


# The four disease configurations.
DISEASES = {
    "diarrhea": Disease("diarrhea", ("Diarrhea", "Diarrhea, acute, nonspecific",
                                     "Diarrhea and vomiting, acute, nonspecific"), (2, 365), (0, 1)),
    "uri": Disease("uri", ("Kennel cough", "URI, feline"), (4, 365), (0, 3)),
    "parvo": Disease("parvo", ("Parvovirus, canine", "Parvovirus, feline, suspected",
                               "Parvovirus, feline, confirmed"), (4, 365), (0, 3),
                     gap_fill=False, weighted=False),
    "ringworm": Disease("ringworm", ("Ringworm, confirmed",), (8, 365), (0, 7)),
}


def age_group(dob, ref, species) -> Column:
    """Adult at 20+ Sunday-weeks old on the reference date, else Kitten (cats) / Puppy."""
    wk = week_diff(dob, ref)
    s = F.col(species) if isinstance(species, str) else species
    return (F.when(wk >= 20, F.lit("Adult"))
            .when((wk < 20) & (s == "Cat"), F.lit("Kitten"))
            .otherwise(F.lit("Puppy")))


def _cohort_animals(m: Model, d: Disease) -> DataFrame:
    return (m["animals"].where(F.col("Species").isin(list(d.species)) & F.col("has_details"))
            .select("AnimalID", "Name", "Species", "DateOfBirth"))


def _dealt(df: DataFrame, by: list[str], rows: int | None, joined: bool = True) -> DataFrame:
    """``df`` dealt by ``by`` where its rows are known; else the planner places it (or its buckets have)."""
    return df if rows is None else deal(df, by, rows, joined=joined)


def _listed_exams(m: Model, d: Disease, spine: MonthSpine) -> DataFrame:
    """Exams with a listed condition inside a report month, closed at 00:00 of the last day (Q3)."""
    e = m["exam_conditions"].where(F.col("Condition").isin(list(d.conditions)))
    e = bounded(e, "DateCreated", spine.first, _add_months(spine.last, 1))
    e = e.withColumn("reference_date", month_start("DateCreated")).where(spine.in_spine("reference_date"))
    if not d.closed_month:
        e = e.where(F.col("DateCreated") <= month_end_midnight("reference_date"))
    return e.select("AnimalID", "Condition", "DateCreated", "reference_date")


def incidence_numerator(m: Model, spine: MonthSpine, disease: Disease) -> DataFrame:
    """One row per (animal, condition, month) with an exam ``lo..hi`` days after an intake.

    A visit matches some exam of a (animal, condition, month) group iff its day
    lies in ``[min exam day - hi, max exam day - lo]`` (the window is longer than
    a month), so the intake maxima are taken over the days of that range; the
    first exam that has a match is the first one on or after the earliest
    matching visit + ``lo`` days.
    """
    lo, hi = disease.onset_days
    animals = _cohort_animals(m, disease)
    exams = _listed_exams(m, disease, spine).withColumn("eday", F.to_date("DateCreated"))
    # intakes that any report month can see: literal bounds for the scan
    first_day = spine.first - _dt.timedelta(days=hi)
    intakes = bounded(m["visits"].where(F.col("IntakeType").isin(list(disease.intake_types))),
                      "tin_DateCreated", first_day, _add_months(spine.last, 1))
    if hi - lo < 31 or lo < 1:
        return _numerator_rows(_short_window_matches(exams, intakes, lo, hi), animals)
    # Both sides shrink to one row per day of an animal, dealt by (animal, month or day): a hot animal spreads. Then
    # each month's exam days meet the animal's intake days as lists, no longer than the calendar.
    n_exams, n_visits = known_rows(m, "statuses"), known_rows(m, "visits")
    days = (_dealt(exams, ["AnimalID", "reference_date"], n_exams, joined=False)
            .groupBy("AnimalID", "Condition", "reference_date", "eday").agg(F.min("DateCreated").alias("DateCreated")))
    groups = days.groupBy("AnimalID", "Condition", "reference_date").agg(
        F.min("eday").alias("mind"), F.max("eday").alias("maxd"), F.collect_list(F.struct("eday", "DateCreated")).alias("_exams"))
    visits = intakes.select("AnimalID", "IntakeType", "tin_DateCreated", F.to_date("tin_DateCreated").alias("vday"))
    visits = (_dealt(visits, ["AnimalID", "vday"], n_visits).groupBy("AnimalID", "vday")
              .agg(F.max("IntakeType").alias("IntakeType"), F.max("tin_DateCreated").alias("tin_DateCreated")))
    visits = (_dealt(visits, ["AnimalID"], n_visits).groupBy("AnimalID")
              .agg(F.collect_list(F.struct("vday", "tin_DateCreated", "IntakeType")).alias("_visits")))
    met = join_large(_dealt(groups, ["AnimalID"], n_visits), visits, "AnimalID")
    fits = F.filter("_visits", lambda v: (v["vday"] >= F.date_sub("mind", hi)) & (v["vday"] <= F.date_sub("maxd", lo)))
    matched = (met.withColumn("_fits", fits).where(F.size("_fits") > 0)
               .withColumn("_from", F.date_add(F.array_min(F.transform("_fits", lambda v: v["vday"])), lo))
               .select("AnimalID", "Condition", "reference_date",
                       F.array_max(F.transform("_fits", lambda v: v["IntakeType"])).alias("Intaketype"),
                       F.array_max(F.transform("_fits", lambda v: v["tin_DateCreated"])).alias("intakedate"),
                       F.array_min(F.transform(F.filter("_exams", lambda e: e["eday"] >= F.col("_from")),
                                               lambda e: e["DateCreated"])).alias("examdate")))
    return _numerator_rows(matched, _dealt(animals, ["AnimalID"], n_visits))


def _short_window_matches(exams: DataFrame, intakes: DataFrame, lo: int, hi: int) -> DataFrame:
    """The numerator's matches for any window, by day: each intake meets the exams of the days it allows.

    Windows shorter than a month (or from day 0 on, where the exam must be later than the intake);
    a longer one than that works too, only with more rows per intake.
    """
    days = (intakes.select("AnimalID", "IntakeType", "tin_DateCreated",
                           F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("_k"))
            .withColumn("eday", F.date_add(F.to_date("tin_DateCreated"), F.col("_k"))))
    return (join_large(exams.distinct(), days, ["AnimalID", "eday"])
            .where(F.col("DateCreated") > F.col("tin_DateCreated"))
            .groupBy("AnimalID", "Condition", "reference_date")
            .agg(F.max("IntakeType").alias("Intaketype"), F.max("tin_DateCreated").alias("intakedate"),
                 F.min("DateCreated").alias("examdate")))


def _numerator_rows(matched: DataFrame, animals: DataFrame) -> DataFrame:
    out = join_large(matched, animals, "AnimalID").where(F.col("DateOfBirth").isNotNull())
    return out.select(
        F.col("AnimalID").alias("animalid"), F.col("Name").alias("name"), F.col("Species").alias("species"),
        F.col("DateOfBirth").alias("dateofbirth"), "Intaketype", F.col("Condition").alias("condition"),
        "intakedate", "examdate", F.col("reference_date").alias("Referencedate"),
        age_group("DateOfBirth", "reference_date", "Species").alias("Agegroup"))


def _inventory_base(m: Model, d: Disease, spine: MonthSpine) -> DataFrame:
    """Status rows of listed stages joined to their own visit (left)."""
    rows = known_rows(m, "statuses")
    st = bounded(m["statuses"].where(F.col("Stage").isin(list(d.stages))), "LastUpdated", _add_months(spine.first, -12))
    v = _dealt(m["visits"].select(F.col("AnimalID").alias("_vid"), F.col("InPrimaryKey"), "IntakeType", "tin_DateCreated"),
               ["_vid", "InPrimaryKey"], rows)
    base = join_large(st, v, (F.col("AnimalID") == F.col("_vid"))
                      & (F.col("OperationPrimaryID") == F.col("InPrimaryKey")), "left")
    return base.where(isin_or_null("IntakeType", d.intake_types)).select(
        "AnimalID", "Stage", "Status", F.col("LastUpdated").alias("ts"), "tin_DateCreated")


def stock_population(m: Model, spine: MonthSpine, disease: Disease) -> DataFrame:
    """C2 stock: animals whose latest listed-stage row in (ref - 1y, ref] is active.

    A status row counts for month M while ``M - 1y < ts <= M`` (and, when it has
    a visit, ``M - 1y <= intake``): at most 12 months per row. Past intakes use
    the inventory bound ``ts >= M - 1y`` only (Q5).
    """
    base, rows = _inventory_base(m, disease, spine), known_rows(m, "statuses")
    tin_cap = F.add_months(month_start("tin_DateCreated"), 12)
    latest_hi = F.add_months(last_month_start_before("ts"), 12)
    latest_hi = F.when(F.col("tin_DateCreated").isNull(), latest_hi).otherwise(F.least(latest_hi, tin_cap))
    # Latest stage date and, among active rows at that instant, the smallest stage (Q4); latest intake of the past.
    # Each status row gives one span of months for either. Dealt by (animal, month), so that a hot animal spreads, the
    # spans of equal months are combined before they are dealt by animal and written out as months. The keys are
    # fixed-width (time, stage rank): hash aggregates only.
    order = collation_of(base, "Stage")
    ts = F.col("ts")  # zone-less timestamp: a fixed-width aggregation key as it is
    rank = F.when(F.col("Status") == "A", -rank_code("Stage", disease.stages, order))
    coded = base.select("AnimalID", "ts", "tin_DateCreated", rank.alias("_r"),
                        month_start(F.coalesce("tin_DateCreated", ts)).alias("_b"))
    active = F.when(F.col("_r").isNotNull(), F.struct(ts.alias("t"), F.col("_r").alias("r")))
    past_lo, past_hi = F.add_months(month_start("tin_DateCreated"), 1), F.least(F.add_months(month_start("ts"), 12), tin_cap)
    came = F.col("tin_DateCreated").isNotNull()
    latest_span = F.struct(first_month_start_on_or_after("ts").alias("lo"), latest_hi.alias("hi"), ts.alias("t"),
                           active.alias("a"), F.lit(None).cast("timestamp_ntz").alias("tin"))
    past_span = F.struct(past_lo.alias("lo"), past_hi.alias("hi"), F.lit(None).cast("timestamp_ntz").alias("t"),
                         F.lit(None).cast("struct<t:timestamp_ntz,r:int>").alias("a"), F.col("tin_DateCreated").alias("tin"))
    spans = (_dealt(coded, ["AnimalID", "_b"], rows, joined=False)
             .select("AnimalID", "_b", F.explode(F.when(came, F.array(latest_span, past_span)).otherwise(F.array(latest_span))).alias("_s"))
             .groupBy("AnimalID", "_b", F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
             .agg(F.max("_s.t").alias("_t"), F.max("_s.a").alias("_a"), F.max("_s.tin").alias("_tin")).drop("_b"))
    months = (explode_months(_dealt(spans, ["AnimalID"], rows, joined=False), "_lo", "_hi", spine)
              .groupBy("AnimalID", "reference_date")
              .agg(F.max("_t").alias("_t"), F.max("_a").alias("_a"), F.max("_tin").alias("intakedate")))
    found = (months.where((F.col("_a.t") == F.col("_t")) & F.col("intakedate").isNotNull())
             .select("AnimalID", "reference_date", F.col("_t").alias("stagedate"),
                     rank_decode(-F.col("_a.r"), disease.stages, order).alias("stage"), "intakedate"))
    animals = _dealt(_cohort_animals(m, disease).where(F.col("DateOfBirth").isNotNull()), ["AnimalID"], rows)
    out = join_large(found, animals, "AnimalID")
    return out.select(
        F.col("AnimalID").alias("animalid"), F.col("Name").alias("name"), F.col("Species").alias("species"),
        F.col("DateOfBirth").alias("dateofbirth"), "stagedate", F.lit("A").alias("status"), "stage",
        "intakedate", F.col("reference_date").alias("Referencedate"),
        age_group("DateOfBirth", "reference_date", "Species").alias("Agegroup"))


def flow_population(m: Model, spine: MonthSpine, disease: Disease) -> DataFrame:
    """C2 flow: completed intakes in the month (before 00:00 of its last day) of
    animals without an exam ``0..k`` days after an intake in that month."""
    animals = _cohort_animals(m, disease)
    completed = m["intake_status"].where(F.col("OperationStatus") == "Completed").select(
        F.col("OperationRecordID").alias("InPrimaryKey"), F.col("StatusDateTime").alias("tin_DateCreated"))
    listed = m["visits"].where(F.col("IntakeType").isin(list(disease.intake_types)))
    v = (bounded(listed, "tin_DateCreated", spine.first, _add_months(spine.last, 1))
         .withColumn("reference_date", month_start("tin_DateCreated")).where(spine.in_spine("reference_date")))
    if not disease.closed_month:
        v = v.where(F.col("tin_DateCreated") < month_end_midnight("reference_date"))
    n_exams, n_visits = known_rows(m, "statuses"), known_rows(m, "visits")
    visit_key = ["InPrimaryKey", "tin_DateCreated"]
    intakes = join_large(*[_dealt(x, visit_key, n_visits) for x in (v, completed)], visit_key, "left_semi")
    # Early-onset exclusion: any listed exam in the month within lo..hi days after any listed intake.
    e_lo, e_hi = disease.early_days
    exams = _listed_exams(m, disease, spine)
    first_day = spine.first - _dt.timedelta(days=e_hi)
    all_visits = bounded(listed, "tin_DateCreated", first_day, _add_months(spine.last, 1))
    excluded = exists_prior_within_days(exams, all_visits, ["AnimalID"], "DateCreated", "tin_DateCreated",
                                        e_lo, e_hi, n_exams).select("AnimalID", "reference_date")
    month = ["AnimalID", "reference_date"]
    agg = _dealt(intakes.select(*month, "tin_DateCreated"), month, n_visits).groupBy(*month).agg(
        F.max("tin_DateCreated").alias("intakedate"))
    agg = join_large(agg, _dealt(excluded, month, n_visits).distinct(), month, "left_anti")
    born = animals.where(F.col("DateOfBirth").isNotNull())
    out = join_large(*[_dealt(x, ["AnimalID"], n_visits) for x in (agg, born)], "AnimalID")
    return out.select(
        F.col("AnimalID").alias("animalid"), F.col("Name").alias("name"), F.col("Species").alias("species"),
        F.col("DateOfBirth").alias("dateofbirth"),
        as_timestamp("reference_date").alias("stagedate"), F.lit("A").alias("status"),
        F.lit("Intake").alias("stage"), "intakedate", F.col("reference_date").alias("Referencedate"),
        age_group("DateOfBirth", "reference_date", "Species").alias("Agegroup"))


def population_at_risk(m: Model, spine: MonthSpine, disease: Disease) -> DataFrame:
    """Stock UNION ALL flow."""
    return stock_population(m, spine, disease).unionByName(flow_population(m, spine, disease))


def harmonise_outcomes(numerator: DataFrame, denominator: DataFrame, disease: Disease) -> DataFrame:
    """Chart rows (Healthy denominator + Infected numerator), weight 1, month gap fill."""
    cols = ["animalid", "species", "Agegroup", "Outcome", "Intaketype", "Referencedate"]
    den = denominator.withColumn("Outcome", F.lit("Healthy")).withColumn("Intaketype", F.lit("Denominator"))
    num = numerator.withColumn("Outcome", F.lit("Infected"))
    chart = den.select(*cols).unionByName(num.select(*cols))
    if not disease.weighted:
        return chart
    chart = chart.withColumn("sum", F.lit(1))
    if not disease.gap_fill:
        return chart
    months = chart.agg(F.min("Referencedate").alias("_lo"), F.max("Referencedate").alias("_hi")).select(
        F.explode(F.sequence(month_start("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("Referencedate"))
    infected = chart.where(F.col("Outcome") == "Infected")
    missing = fill_missing_months(infected, "Referencedate", months, list(FILL_GRID),
                                  {"Outcome": "Infected", "sum": 0})
    missing = missing.select(F.lit(None).cast("bigint").alias("animalid"), "species", "Agegroup", "Outcome",
                             F.lit(None).cast("string").alias("Intaketype"), "Referencedate", "sum")
    return chart.unionByName(missing)


def infection_percent(chart: DataFrame, as_of: _dt.date) -> DataFrame:
    """C4 after P11: per (species, month, age group) infected / healthy x 100, 2 decimals.

    Zero healthy gives NULL (the reference divides to inf, Q6).
    """
    recent = trailing_months(chart, as_timestamp("Referencedate"), as_of, 13)
    piv = (recent.groupBy("species", F.col("Referencedate").alias("Month"), "Agegroup")
           .agg(F.sum(F.when(F.col("Outcome") == "Healthy", F.col("sum")).otherwise(0)).alias("Healthy"),
                F.sum(F.when(F.col("Outcome") == "Infected", F.col("sum")).otherwise(0)).alias("Infected")))
    pct = F.round(F.try_divide(F.col("Infected").cast("double"), F.col("Healthy").cast("double")) * 100, 2)
    return piv.select("species", "Month", "Agegroup", pct.alias("infection_percent"))


def incidence_report(m: Model, spine: MonthSpine, disease: Disease, as_of: _dt.date) -> dict[str, DataFrame]:
    """Whole report: numerator, denominator, chart rows and the percent table."""
    num = materialize(incidence_numerator(m, spine, disease))
    den = materialize(population_at_risk(m, spine, disease))
    chart = harmonise_outcomes(num, den, disease)
    out = {"numerator": num, "denominator": den, "chart": chart}
    if disease.weighted:
        out["percent"] = infection_percent(chart, as_of)
    return out


def infection_percent_report(m: Model, spine: MonthSpine, disease: Disease, as_of: _dt.date) -> DataFrame:
    """The percent table alone: only the trailing months of P11 are computed.

    Every month's rows stand for themselves; only the gap fill looks at the first and the
    last month with any row. If the trailing months have rows in their own first and last
    month, no month outside can matter; else the whole spine is computed.
    """
    cut = spine.trailing(as_of)
    if cut is not None:
        num = materialize(incidence_numerator(m, cut, disease))
        den = materialize(population_at_risk(m, cut, disease))
        months = num.select("Referencedate").union(den.select("Referencedate"))
        if tuple(months.agg(F.min("Referencedate"), F.max("Referencedate")).first()) == (cut.first, cut.last):
            return infection_percent(harmonise_outcomes(num, den, disease), as_of)
    return incidence_report(m, spine, disease, as_of)["percent"]
