"""Resolved shelter model: the joined dimension views every report reads.

``resolve`` turns raw shelter tables (``sources.tables.SHELTER_SCHEMAS``) into
the resolved frames below; ``plans.roles`` builds the same frames from the
benchmark tables. Reports only read these frames.

=================  =============================================================
frame              columns
=================  =============================================================
animals            AnimalID, Name, Species, Sex, DateOfBirth, has_details
visits             InPrimaryKey, AnimalID, tin_DateCreated, IntakeType,
                   IntakeSubType, OutComeType
visits_out         visits + tOut_DateCreated
intake_status      OperationRecordID, StatusDateTime, OperationStatus
exam_conditions    ExamConditionID, ExamID, AnimalID, Condition, DateCreated,
                   DateTimeDiagnosed
statuses           AnimalID, Stage, Status, LastUpdated, OperationPrimaryID
locations          AnimalID, Location, LastUpdated
euthanasia         AnimalID, DateCreated
treatments         ExamTreatmentID, ExamID, AnimalID, TreatmentID, Medication,
                   StatusDateTime, DateCreated, SiteName, SurgeonName,
                   AssistantName
=================  =============================================================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelterlens.functions.predicates import concat_null

Model = dict[str, DataFrame]


def resolve(t: dict[str, DataFrame]) -> Model:
    """Join raw shelter tables into the resolved model (lazy; nothing runs)."""
    a = t["Animal"].alias("a")
    animals = (a.join(t["refSpecies"], "SpeciesID", "inner")
               .join(t["AnimalDetails"].withColumn("has_details", F.lit(True)), "AnimalID", "left")
               .select("AnimalID", "Name", "Species", "Sex", "DateOfBirth",
                       F.coalesce("has_details", F.lit(False)).alias("has_details")))
    visits_out = t["txnVisit"].select("InPrimaryKey", "AnimalID", "tin_DateCreated", "IntakeType",
                                      "IntakeSubType", "OutComeType", "tOut_DateCreated")
    visits = visits_out.drop("tOut_DateCreated")
    intake_status = (t["IntakeStatusHistory"]
                     .join(t["refOperationStatus"],
                           F.col("StatusID") == F.col("OperationStatusID"), "inner")
                     .select("OperationRecordID", "StatusDateTime", "OperationStatus"))
    exam_conditions = (t["ExamCondition"].join(t["refCondition"], "ConditionID", "inner")
                       .select("ExamConditionID", "ExamID", "AnimalID", "Condition", "DateCreated",
                               "DateTimeDiagnosed"))
    statuses = (t["HistoryStatus"].join(t["refAnimalStage"], "StageID", "left")
                .select("AnimalID", "Stage", "Status", "LastUpdated", "OperationPrimaryID"))
    locations = (t["HistoryLocation"].join(t["refLocations"], "LocationID", "inner")
                 .select("AnimalID", "Location", "LastUpdated"))
    surgeon = t["Person"].select(F.col("PersonID").alias("PerformedBy"),
                                 concat_null("NameFirst", F.lit(" "), "NameLast").alias("SurgeonName"))
    assistant = t["Person"].select(F.col("PersonID").alias("AssistantID"),
                                   concat_null("NameFirst", F.lit(" "), "NameLast").alias("AssistantName"))
    treatments = (t["ExamTreatment"].join(t["Site"], "SiteID", "inner")
                  .join(surgeon, "PerformedBy", "left").join(assistant, "AssistantID", "left")
                  .select("ExamTreatmentID", "ExamID", "AnimalID", "TreatmentID", "Medication",
                          "StatusDateTime", "DateCreated", "SiteName", "SurgeonName", "AssistantName"))
    return {
        "animals": animals, "visits": visits, "visits_out": visits_out,
        "intake_status": intake_status, "exam_conditions": exam_conditions,
        "statuses": statuses, "locations": locations,
        "euthanasia": t["Euthanasia"].select("AnimalID", "DateCreated"),
        "treatments": treatments,
    }


def known_rows(model: Model, frame: str) -> int | None:
    """Rows of a frame where the model knows them without building it (None: left to the planner, as for
    stored models, whose buckets place the rows already)."""
    rows = getattr(model, "rows", None)
    return rows(frame) if rows else None


def packed(model: Model, frame: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A frame without the columns that follow from its others, and what adds them to its rows: texts such as a
    line's id need not go through shuffles and stored tables when the numbers they are made of do. Models that
    know no such columns give the frame itself."""
    found = getattr(model, "packed", {}).get(frame)
    return (found[0](), found[1]) if found else (model[frame], lambda df: df)


def with_collation(model: Model, collation: str) -> Model:
    """Q1: the model with its text columns under a collation (``UNICODE_CI``, ``UTF8_LCASE``, ...).

    The original compares and orders texts by its database's collation, the reports here by bytes. The
    collation is declared once, on the columns, as a database does: IN, ``=``, max / min, ordering,
    grouping and joins of every report that reads the model follow it. Texts that are equal under
    it are one value, of which any spelling may be shown. Filters on such columns are not pushed into parquet scans.
    Frames are built on first use.
    """
    return _Collated(model, collation)


class _Collated(dict):
    def __init__(self, model: Model, collation: str):
        super().__init__()
        self._model, self._collation = model, collation

    def __missing__(self, name: str) -> DataFrame:
        df = self._model[name]
        self[name] = df.select(*[
            F.collate(F.col(f"`{f.name}`"), self._collation).alias(f.name) if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`") for f in df.schema])
        return self[name]
