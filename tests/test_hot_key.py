"""One animal holding most of the rows: the pair-free C1 formulation against a
brute-force listing of every (visit, exam) pair."""
import datetime as dt
import random

from week_reference import python_week_diff
from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import incidence as inc
from shelterlens.sources.model import resolve
from shelterlens.sources.tables import SHELTER_SCHEMAS

T = dt.datetime
TYPES = ["Stray", "TransferIn", "[Return]", "OwnerSurrender", "Transport"]
CONDS = ["Diarrhea", "Diarrhea, acute, nonspecific", "Kennel cough"]


def _ts(rng, start, days):
    return start + dt.timedelta(days=rng.randint(0, days), hours=rng.choice([0, 0, 7, 13, 23]))


def test_numerator_with_a_hot_animal(spark):
    rng = random.Random(42)
    animals = list(range(1, 7))
    visits, exams = [], []
    for i in range(600):
        a = 1 if i % 3 else rng.choice(animals)          # animal 1 holds two thirds of the rows
        visits.append((i, a, _ts(rng, T(2023, 1, 1), 540), None, rng.choice(TYPES), "s", None))
        exams.append((i, i, a, rng.randint(1, 3), _ts(rng, T(2023, 6, 1), 400), None))
    exams = [(e[0], e[1], e[2], e[3], e[4], e[4]) for e in exams]
    rows = {n: [] for n in SHELTER_SCHEMAS}
    rows.update({
        "Animal": [(a, f"A{a}", 1 if a % 2 else 2, "F") for a in animals],
        "refSpecies": [(1, "Cat"), (2, "Dog")],
        "AnimalDetails": [(a, T(2022, 12, 1) if a != 6 else None) for a in animals],
        "txnVisit": visits, "ExamCondition": exams,
        "refCondition": [(k + 1, c) for k, c in enumerate(CONDS)],
    })
    m = resolve({n: spark.createDataFrame(r, SHELTER_SCHEMAS[n]) for n, r in rows.items()})
    months = [dt.date(2023, mo, 1) for mo in range(6, 13)] + [dt.date(2024, mo, 1) for mo in range(1, 7)]
    d = inc.DISEASES["diarrhea"]
    got = {(r.animalid, r.condition, r.Referencedate): (r.Intaketype, r.intakedate, r.examdate)
           for r in inc.incidence_numerator(m, MonthSpine(months), d).collect()}

    want = {}
    for _, _, a, cid, ets, _ in exams:
        cond = CONDS[cid - 1]
        month = dt.date(ets.year, ets.month, 1)
        nxt = dt.date(ets.year + ets.month // 12, ets.month % 12 + 1, 1)
        last_midnight = dt.datetime.combine(nxt - dt.timedelta(days=1), dt.time())
        if cond not in d.conditions or month not in months or ets > last_midnight or a == 6:
            continue
        for _, va, tin, _, typ, _, _ in visits:
            if va != a or typ not in d.intake_types or not tin < ets:
                continue
            if not 2 <= (ets.date() - tin.date()).days <= 365:
                continue
            k = (a, cond, month)
            t0, i0, e0 = want.get(k, (None, None, None))
            want[k] = (max(typ, t0) if t0 else typ, max(tin, i0) if i0 else tin, min(ets, e0) if e0 else ets)
    assert got == want
    assert sum(1 for k in want if k[0] == 1) > 10
    assert python_week_diff(dt.date(2022, 12, 1), dt.date(2023, 6, 1)) >= 20
