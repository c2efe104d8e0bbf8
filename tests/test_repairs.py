"""Options that repair quirks of the original reports; the defaults keep them."""
import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import incidence as inc
from shelterlens.plans import kitten as kt
from shelterlens.plans import stay as sy
from shelterlens.plans import wait as wt
from shelterlens.sources.model import resolve
from shelterlens.sources.tables import SHELTER_SCHEMAS

T, D = dt.datetime, dt.date


def _model(spark, **rows):
    base = {n: [] for n in SHELTER_SCHEMAS}
    base.update({"refSpecies": [(1, "Cat")], "refOperationStatus": [(1, "Completed")],
                 "refCondition": [(1, "Diarrhea")], **rows})
    return resolve({n: spark.createDataFrame(r, SHELTER_SCHEMAS[n]) for n, r in base.items()})


def test_closed_month_counts_the_last_day(spark):
    m = _model(spark, Animal=[(1, "A", 1, "F")], AnimalDetails=[(1, T(2020, 1, 1))],
               txnVisit=[(1, 1, T(2024, 3, 1), None, "Stray", "s", None), (2, 1, T(2024, 3, 31, 8), None, "Stray", "s", None)],
               IntakeStatusHistory=[(1, 1, T(2024, 3, 1)), (2, 1, T(2024, 3, 31, 8))],
               ExamCondition=[(1, 1, 1, 1, T(2024, 3, 31, 15), T(2024, 3, 31, 15))])
    spine, d = MonthSpine([D(2024, 3, 1)]), inc.DISEASES["diarrhea"]
    fixed = dataclasses.replace(d, closed_month=True)
    assert inc.incidence_numerator(m, spine, d).count() == 0
    assert [r.examdate for r in inc.incidence_numerator(m, spine, fixed).collect()] == [T(2024, 3, 31, 15)]
    assert [r.intakedate for r in inc.flow_population(m, spine, d).collect()] == [T(2024, 3, 1)]
    # the exam now lies within a day of the second intake: the animal leaves the flow
    assert inc.flow_population(m, spine, fixed).count() == 0


def test_same_year_label(spark):
    df = spark.createDataFrame([(D(2023, 3, 5), D(2024, 4, 1)), (D(2024, 3, 5), D(2024, 4, 1))], "i date, r date")
    got = df.select(sy._type_label(F.col("i"), F.col("r")).alias("a"), sy._type_label(F.col("i"), F.col("r"), True).alias("b"))
    assert [tuple(r) for r in got.collect()] == [("New Intake", "Already in Shelter"), ("New Intake", "New Intake")]


def test_only_missing_cells(spark):
    cohort = spark.createDataFrame(
        [(1, "A", "Stray", D(2024, 1, 1), D(2024, 1, 2), 0, D(2024, 2, 1), "Alive", "0-2 wks", D(2024, 2, 1)),
         (2, "B", "Stray", D(2024, 1, 1), D(2024, 1, 2), 0, D(2024, 3, 9), "Died", "3-6 wks", D(2024, 3, 1))],
        "Animalid long, Name string, IntakeType string, Dateofbirth date, Intakedate date, IntakeAge long, "
        "ReferenceDate date, Outcometype string, Agegroup string, reference_date date")
    cells = len(kt.AGE_BANDS) * len(kt.FILL_OUTCOMES)
    assert kt.fill_kitten_grid(cohort).count() == 2 + 2 * cells
    assert kt.fill_kitten_grid(cohort, only_missing=True).count() == 2 * cells
    wait = spark.createDataFrame(
        [(1, "Cat", "Spay", T(2024, 2, 1, 5), 3), (2, "Dog", "Neuter", T(2024, 3, 5), 30)],
        "AnimalID long, Species string, Surgerycategory string, SurgeryDate timestamp_ntz, SurgeryWait int")
    assert wt.wait_buckets(wait, D(2024, 3, 20)).count() == 2 + 2 * 4
    assert wt.wait_buckets(wait, D(2024, 3, 20), only_missing=True).count() == 2 + 2 * 4 - 2


def _stay_model(spark):
    # animal 1's latest status is inactive, at the instant of an active row of animal 2; animal 3 never left
    return _model(spark, Animal=[(1, "A", 1, "F"), (2, "B", 1, "F"), (3, "C", 1, "F")],
                  txnVisit=[(1, 1, T(2024, 1, 5), T(2024, 6, 1), "Stray", "s", "Adoption"),
                            (2, 2, T(2024, 1, 5), T(2024, 6, 1), "Stray", "s", "Adoption"),
                            (3, 3, T(2024, 1, 5), None, "Stray", "s", None)],
                  HistoryStatus=[(1, 1, "I", T(2024, 2, 1, 9), 1), (2, 1, "A", T(2024, 2, 1, 9), 2),
                                 (3, 1, "A", T(2024, 2, 2), 3)])


def test_match_animal_and_open_stays(spark):
    m, spine = _stay_model(spark), MonthSpine([D(2024, 4, 1)])

    def held(**options):
        return sorted(r.animalid for r in sy.los_not_outcomed(m, spine, **options).collect())
    assert held() == [1, 2]
    assert held(match_animal=True) == [2]
    assert held(open_stays=True) == [1, 2, 3]
    assert held(match_animal=True, open_stays=True) == [2, 3]


def test_open_stays_of_kittens(spark):
    m = _model(spark, Animal=[(1, "A", 1, "F"), (2, "B", 1, "F")],
               AnimalDetails=[(1, T(2024, 2, 20)), (2, T(2024, 2, 20))],
               txnVisit=[(1, 1, T(2024, 2, 25), T(2024, 3, 20), "Stray", "s", "Adoption"),
                         (2, 2, T(2024, 2, 25), None, "Stray", "s", None)])
    spine = MonthSpine([D(2024, 3, 1), D(2024, 8, 1)])

    def alive(**options):
        rows = kt.kitten_cohort(m, spine, D(2024, 8, 15), D(2024, 1, 1), **options).collect()
        return {(r.Animalid, r.Agegroup, r.reference_date.month) for r in rows}
    assert {a for a, _, _ in alive()} == {1}
    assert {(a, b) for a, b, _ in alive(open_stays=True)} == {(1, "0-2 wks"), (1, "3-6 wks"), (2, "0-2 wks"), (2, "3-6 wks")}
    assert {mon for _, _, mon in alive(open_stays=True)} == {3}   # over 20 weeks old in August


def test_intake_per_treatment(spark):
    # exam 1: a spay on the 10th, another treatment on the 25th; an intake between the two
    m = _model(spark, Animal=[(1, "A", 1, "F")], AnimalDetails=[(1, T(2020, 1, 1))], Site=[(1, "S")],
               refAnimalStage=[(1, "Evaluate")], HistoryStatus=[(1, 1, "A", T(2024, 1, 2), 1)],
               txnVisit=[(1, 1, T(2024, 1, 3), None, "Stray", "s", None), (2, 1, T(2024, 1, 15), None, "Stray", "s", None)],
               ExamTreatment=[(1, 1, 1, 1, "Ovariohysterectomy", T(2024, 1, 10), T(2024, 1, 10), 1, None, None),
                              (2, 1, 1, 1, "Bandage", T(2024, 1, 25), T(2024, 1, 25), 1, None, None)])
    spine = MonthSpine([D(2024, 2, 1)])

    def wait(**options):
        return [(r.IntakeDate, r.SurgeryWait) for r in wt.surgery_wait(m, spine, spark, D(2019, 1, 1), **options).collect()]
    assert wait() == [(T(2024, 1, 15), -5)]
    assert wait(per_treatment=True) == [(T(2024, 1, 3), 7)]
