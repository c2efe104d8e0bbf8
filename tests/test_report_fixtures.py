"""Shelter-shaped fixtures for the delayed, surgery and stay reports (hand-computed)."""
import datetime as dt

import pytest

from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import delayed as dl
from shelterlens.plans import stay as sy
from shelterlens.plans import surgery as sx
from shelterlens.sources.model import resolve
from shelterlens.sources.tables import SHELTER_SCHEMAS

T = dt.datetime
D = dt.date


def _model(spark, **rows):
    base = {n: [] for n in SHELTER_SCHEMAS}
    base.update({"refSpecies": [(1, "Cat"), (2, "Dog"), (3, "Rabbit")],
                 "refLocations": [(1, "Kennel"), (2, "Off Site Clinic"), (3, "Fosters")],
                 "refAnimalStage": [(1, "Evaluate")], "refOperationStatus": [(1, "Completed")],
                 "Site": [(1, "Main")]})
    base.update(rows)
    return resolve({n: spark.createDataFrame(r, SHELTER_SCHEMAS[n]) for n, r in base.items()})


def test_delayed_outcome_rules(spark):
    m = _model(spark,
               Animal=[(i, f"A{i}", 3 if i == 5 else 1, "F") for i in range(1, 6)],
               AnimalDetails=[(i, T(2020, 1, 1)) for i in range(1, 6)],
               txnVisit=[(1, 1, T(2024, 3, 1, 10), None, "Stray", "s", None),
                         (2, 1, T(2024, 3, 2), None, "Stray", "s", None),         # 3 days: outside 4..21
                         (3, 2, T(2024, 2, 10), None, "Stray", "s", None),        # 22 days
                         (4, 2, T(2024, 2, 11), None, "Stray", "s", None),        # 21 days
                         (5, 3, T(2024, 3, 1, 8), None, "TransferIn", "s", None),  # two intakes on one day
                         (6, 3, T(2024, 3, 1, 12), None, "Stray", "s", None),
                         (7, 4, T(2024, 3, 10), None, "Stray", "s", None),
                         (8, 5, T(2024, 3, 1), None, "Stray", "s", None)],       # rabbit
               Euthanasia=[(1, T(2024, 3, 5, 9)), (2, T(2024, 3, 3)), (3, T(2024, 3, 10)),
                           (4, T(2024, 3, 20)), (4, T(2024, 3, 25)), (5, T(2024, 3, 10))])
    got = {r.AnimalID: r for r in dl.delayed_outcome(m, MonthSpine([D(2024, 4, 1)])).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[1].TimetoEuth == 4 and got[2].TimetoEuth == 21 and got[4].TimetoEuth == 10
    assert got[3].IntakeType == "TransferIn" and got[3].IntakeDate == T(2024, 3, 1, 8)
    assert got[4].EuthanizedDate == T(2024, 3, 20)


def test_surgery_denominator_rules(spark):
    et = [  # ExamTreatmentID, ExamID, AnimalID, TreatmentID, Medication, StatusDateTime, DateCreated, Site, By, Asst
        (1, 100, 1, 1, "Ovariohysterectomy", T(2024, 3, 5, 9), T(2024, 3, 5), 1, 1, None),
        (2, 100, 1, 2, "Mass Removal", T(2024, 3, 5, 11), T(2024, 3, 5), 1, 1, None),
        (3, 101, 1, 3, "Orchidectomy", T(2024, 3, 6, 9), T(2024, 3, 6), 1, 1, None),
        (4, 102, 1, 3, "Orchidectomy", T(2024, 3, 6, 15), T(2024, 3, 6), 1, 1, None),
        (5, 103, 2, 1, "Ovariohysterectomy", T(2024, 3, 7), T(2024, 3, 7), 1, 1, None),
        (6, 104, 3, 1, "Ovariohysterectomy", T(2024, 3, 8), T(2024, 3, 8), 1, 2, None),
        (7, 105, 3, 1, "Ovariohysterectomy", T(2024, 3, 31, 9), T(2024, 3, 31), 1, 1, None),  # after 00:00 of last day
    ]
    m = _model(spark,
               Animal=[(1, "A1", 2, "F"), (2, "A2", 1, "M"), (3, "A3", 3, "U")],
               AnimalDetails=[(i, T(2020, 1, 1)) for i in (1, 2, 3)],
               ExamTreatment=et, Person=[(1, "Ann", "Vet"), (2, None, "Doe")],
               HistoryLocation=[(2, 2, T(2024, 1, 1)), (3, 1, T(2024, 1, 1)), (3, 2, T(2023, 12, 1))])
    got = {r.UniqueSurgeryID: r for r in sx.surgeries(m, MonthSpine([D(2024, 3, 1)])).collect()}
    assert sorted(got) == [1, 2, 3, 6]              # 4: same type same day; 5: only off-site; 7: last day 09:00
    assert got[1].SurgeryCategory_refined == "Multiple" and got[2].SurgeryCategory_refined == "Multiple"
    assert got[3].SurgeryCategory_refined == "Neuter"
    assert got[6].Sex == "F" and got[6].Species == "Special Species" and got[6].SurgeonName is None
    assert got[6].Location == "Kennel" and got[1].Location is None


def test_stay_foster_fan_out(spark):
    m = _model(spark,
               Animal=[(1, "A1", 1, "F"), (2, "A2", 2, "M")],
               txnVisit=[(1, 1, T(2024, 3, 1), T(2024, 3, 20), "Stray", "s", "Adoption"),
                         (2, 1, T(2024, 3, 5), T(2024, 3, 25), "Stray", "s", "Died"),
                         (3, 2, T(2024, 2, 10), T(2024, 3, 15), "Stray", "s", "Adoption")],
               HistoryStatus=[(2, 1, "I", T(2023, 1, 1), None)],
               HistoryLocation=[(1, 3, T(2024, 3, 6)), (1, 1, T(2024, 3, 10)), (1, 3, T(2024, 3, 22))])
    got = sorted(map(tuple, sy.los_outcomed(m, MonthSpine([D(2024, 4, 1)]))
                     .select("animalid", "intakedate", "days_in_foster", "total_los", "days_in_shelter", "Type")
                     .collect()))
    # two stay rows for A1: the single counted spell (6 -> 10 March, 4 days) is doubled (Q10)
    assert got == [(1, D(2024, 3, 1), 8, 19, 11, "New Intake"), (1, D(2024, 3, 5), 8, 20, 12, "New Intake"),
                   (2, D(2024, 2, 10), 0, 34, 34, "Already in Shelter")]


def test_kitten_cohort_rules(spark):
    from shelterlens.plans import kitten as kt
    dob = T(2024, 2, 4)  # a Sunday
    m = _model(spark,
               Animal=[(1, "K1", 1, "F"), (2, "K2", 1, "F"), (3, "K3", 1, "F"), (4, "K4", 1, "F"), (5, "K5", 1, "F"),
                       (6, "D6", 2, "M")],
               AnimalDetails=[(1, dob), (2, dob), (3, T(2023, 10, 1)), (4, T(2024, 3, 3)), (5, dob), (6, dob)],
               txnVisit=[(1, 1, T(2024, 2, 20), T(2024, 4, 10), "Stray", "s", "Adoption"),
                         (2, 2, T(2024, 2, 20), T(2024, 3, 12), "Stray", "s", "Died"),
                         (3, 3, T(2024, 2, 20), T(2024, 4, 10), "Stray", "s", "Adoption"),   # 21 weeks at week starts
                         (4, 4, T(2024, 3, 4), None, "Stray", "s", None),                    # no out date (Q12)
                         (5, 5, T(2024, 2, 20), T(2024, 4, 10), "Stray", "s", "Adoption"),
                         (6, 6, T(2024, 2, 20), T(2024, 4, 10), "Stray", "s", "Adoption")],  # a dog
               Euthanasia=[(5, T(2024, 3, 20))])
    got = sorted((r.Animalid, r.Agegroup, r.Outcometype, r.ReferenceDate)
                 for r in kt.kitten_cohort(m, MonthSpine([D(2024, 3, 1)]), D(2024, 6, 1)).collect())
    assert got == [(1, "3-6 wks", "Alive", D(2024, 3, 1)), (1, "7-12 wks", "Alive", D(2024, 3, 1)),
                   (2, "3-6 wks", "Died", D(2024, 3, 12)), (5, "3-6 wks", "Euthanised", D(2024, 3, 20))]


@pytest.mark.parametrize("width", [1, 2, 1 << 16])
def test_gap_filter_month_wide_and_per_animal(spark, monkeypatch, width):
    monkeypatch.setattr(sx, "ANIMAL_RANGE", width)   # ranges of ids: none, or every animal of its own
    rows = [  # AnimalID, SurgeryType, SxComp, SurgeryTs, CompDate, reference_date
        (1, "Orchidectomy", "Surgical complication", T(2024, 3, 1), T(2024, 3, 2), D(2024, 3, 1)),
        (1, "Ovariohysterectomy", "Surgical complication", T(2024, 3, 1), T(2024, 3, 4), D(2024, 3, 1)),
        (2, "Orchidectomy", "Surgical complication", T(2024, 3, 10), T(2024, 3, 11), D(2024, 3, 1)),
        (2, "Orchidectomy", "Surgical complication", T(2024, 3, 10), T(2024, 3, 11), D(2024, 4, 1)),
    ]
    df = spark.createDataFrame(rows, "AnimalID long, SurgeryType string, SxComp string, SurgeryTs timestamp_ntz, "
                                     "CompDate timestamp_ntz, reference_date date")
    month_wide = sorted((r.AnimalID, r.SurgeryType, r.reference_date)
                        for r in sx.previous_row_gap_filter(df).collect())
    # first row of each month dropped; row 2 only 48 h after row 1; animal 2 compared with animal 1's last row
    assert month_wide == [(2, "Orchidectomy", D(2024, 3, 1))]
    per_animal = sorted((r.AnimalID, r.SurgeryType, r.reference_date)
                        for r in sx.previous_row_gap_filter(df, per_animal=True).collect())
    assert per_animal == [(1, "Orchidectomy", D(2024, 3, 1)), (2, "Orchidectomy", D(2024, 3, 1)),
                          (2, "Orchidectomy", D(2024, 4, 1))]
