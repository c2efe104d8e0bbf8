"""Text order: byte order by default, the collation of the model where one is declared (Q1)."""
import datetime as dt

from pyspark.sql import functions as F

from shelterlens.functions.predicates import collation_of, rank_code, rank_decode
from shelterlens.operators.spine import MonthSpine
from shelterlens.plans import incidence as inc
from shelterlens.plans import wait as wt
from shelterlens.sources.model import resolve, with_collation
from shelterlens.sources.tables import SHELTER_SCHEMAS

T, D = dt.datetime, dt.date


def _model(spark, **rows):
    base = {n: [] for n in SHELTER_SCHEMAS}
    base.update({"refSpecies": [(1, "Cat")], "refOperationStatus": [(1, "Completed")],
                 "refCondition": [(1, "Diarrhea")], **rows})
    return resolve({n: spark.createDataFrame(r, SHELTER_SCHEMAS[n]) for n, r in base.items()})


def test_maximum_and_membership_of_intake_types(spark):
    # animal 1 came twice; animal 2's only intake is spelt in another case
    m = _model(spark, Animal=[(1, "A", 1, "F"), (2, "B", 1, "F")],
               AnimalDetails=[(1, T(2020, 1, 1)), (2, T(2020, 1, 1))],
               txnVisit=[(1, 1, T(2024, 1, 5), None, "[Return]", "s", None),
                         (2, 1, T(2024, 1, 9), None, "OwnerSurrender", "s", None),
                         (3, 2, T(2024, 1, 9), None, "ownersurrender", "s", None)],
               ExamCondition=[(1, 1, 1, 1, T(2024, 3, 10), T(2024, 3, 10)), (2, 2, 2, 1, T(2024, 3, 10), T(2024, 3, 10))])
    spine, d = MonthSpine([D(2024, 3, 1)]), inc.DISEASES["diarrhea"]

    def rows(model):
        return sorted((r.animalid, r.Intaketype) for r in inc.incidence_numerator(model, spine, d).collect())
    assert rows(m) == [(1, "[Return]")]                       # bytes: "[" comes after "O"
    for name in ("UNICODE_CI", "UNICODE"):
        found = rows(with_collation(m, name))
        assert found[0] == (1, "OwnerSurrender"), name         # letters come after "["
        assert len(found) == (2 if name == "UNICODE_CI" else 1)
    assert collation_of(with_collation(m, "UNICODE_CI")["visits"], "IntakeType") == "UNICODE_CI"
    assert collation_of(m["visits"], "IntakeType") == "UTF8_BINARY"


def test_rank_codes_follow_the_collation(spark):
    values = ("b", "A", "a", "_x", "C")
    df = spark.createDataFrame([(v,) for v in ("A", "a", "b", "C", "_x", "zz", None)], "v string")
    for name in ("UTF8_BINARY", "UNICODE_CI", "UTF8_LCASE"):
        rows = df.select("v", rank_code("v", values, name).alias("c")).withColumn("t", rank_decode("c", values, name)).collect()
        code = {r.v: r.c for r in rows}
        assert code["zz"] is None and code[None] is None
        equal = {r.v: r.t for r in rows if r.t is not None}
        if name == "UTF8_BINARY":
            assert [v for v, _ in sorted(((k, c) for k, c in code.items() if c is not None), key=lambda x: x[1])] == sorted(values)
            assert all(v == t for v, t in equal.items())
        else:
            assert code["a"] == code["A"] < code["b"] < code["C"] and equal["a"].lower() == "a"
        order = df.select(F.collate("v", name).alias("v")).where(F.col("v").isin(*values)).orderBy("v").collect()
        assert [code[r.v] for r in order] == sorted(code[r.v] for r in order)


def test_stages_of_the_wait_and_stock_reports(spark):
    # one animal, a stage spelt in another case: only a case-blind collation knows it
    m = _model(spark, Animal=[(1, "A", 1, "F")], AnimalDetails=[(1, T(2020, 1, 1))],
               txnVisit=[(1, 1, T(2023, 11, 1), None, "Stray", "s", None)],
               Site=[(1, "S")], refAnimalStage=[(1, "EVALUATE")],
               HistoryStatus=[(1, 1, "A", T(2023, 12, 1), 1)],
               ExamTreatment=[(1, 1, 1, 1, "Ovariohysterectomy", T(2024, 1, 20), T(2024, 1, 20), 1, None, None)])
    spine, d = MonthSpine([D(2024, 2, 1)]), inc.DISEASES["diarrhea"]

    def wait(model):
        return [(r.AnimalID, r.Stage, r.SurgeryWait) for r in wt.surgery_wait(model, spine, spark, D(2019, 1, 1)).collect()]
    assert wait(m) == [] and wait(with_collation(m, "UNICODE_CI")) == [(1, "EVALUATE", 80)]
    assert inc.stock_population(m, spine, d).count() == 0
    stock = inc.stock_population(with_collation(m, "UTF8_LCASE"), spine, d)
    assert [(r.animalid, r.stage) for r in stock.collect()] == [(1, "Evaluate")]
    both = inc.population_at_risk(with_collation(m, "UTF8_LCASE"), spine, d)
    assert both.count() == 1
