"""Table sources (S1, S2) and the shelter table schemas.

Reports take a ``dict[str, DataFrame]`` of shelter tables. They can come from
parquet folders (``read_parquet_tables``), from a database through JDBC with a
partition column (``read_jdbc_table``), or from the role mapping of the
benchmark tables (``shelterlens.plans.roles``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Shelter tables and their columns (types inferred from use; no DDL exists).
SHELTER_SCHEMAS: dict[str, str] = {
    "Animal": "AnimalID bigint, Name string, SpeciesID bigint, Sex string",
    "refSpecies": "SpeciesID bigint, Species string",
    "AnimalDetails": "AnimalID bigint, DateOfBirth timestamp_ntz",
    "txnVisit": ("InPrimaryKey bigint, AnimalID bigint, tin_DateCreated timestamp_ntz, "
                 "tOut_DateCreated timestamp_ntz, IntakeType string, IntakeSubType string, "
                 "OutComeType string"),
    "refCondition": "ConditionID bigint, Condition string",
    "ExamCondition": ("ExamConditionID bigint, ExamID bigint, AnimalID bigint, ConditionID bigint, "
                      "DateCreated timestamp_ntz, DateTimeDiagnosed timestamp_ntz"),
    "HistoryStatus": ("AnimalID bigint, StageID bigint, Status string, LastUpdated timestamp_ntz, "
                      "OperationPrimaryID bigint"),
    "refAnimalStage": "StageID bigint, Stage string",
    "IntakeStatusHistory": "OperationRecordID bigint, StatusID bigint, StatusDateTime timestamp_ntz",
    "refOperationStatus": "OperationStatusID bigint, OperationStatus string",
    "HistoryLocation": "AnimalID bigint, LocationID bigint, LastUpdated timestamp_ntz",
    "refLocations": "LocationID bigint, Location string",
    "Euthanasia": "AnimalID bigint, DateCreated timestamp_ntz",
    "ExamTreatment": ("ExamTreatmentID bigint, ExamID bigint, AnimalID bigint, TreatmentID bigint, "
                      "Medication string, StatusDateTime timestamp_ntz, DateCreated timestamp_ntz, "
                      "SiteID bigint, PerformedBy bigint, AssistantID bigint"),
    "Site": "SiteID bigint, SiteName string",
    "Person": "PersonID bigint, NameFirst string, NameLast string",
}

def read_driver_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = DRIVER_TABLES) -> dict[str, DataFrame]:
    """S1 for the benchmark layout: one parquet per table under ``sf_dir``."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def read_parquet_tables(spark: SparkSession, root: str, names: Iterable[str] = SHELTER_SCHEMAS) -> dict[str, DataFrame]:
    """Shelter tables stored as ``root/<Table>`` parquet folders."""
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
                    lower: int, upper: int, num_partitions: int, properties: dict | None = None,
                    since: tuple[str, str] | None = None) -> DataFrame:
    """S1 against a live database: parallel range reads on ``partition_column``.

    Zone-less datetimes come as ``timestamp_ntz``, so they do not move with the session
    time zone. ``since``: (datetime column, ISO time); earlier rows stay in the database.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions)
              .option("fetchsize", 10000).option("preferTimestampNTZ", True))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    df = reader.load()
    if since:
        df = df.where(F.col(since[0]) >= F.lit(since[1]).cast("timestamp_ntz"))
    return df


def read_export_csv(spark: SparkSession, path: str, columns: Iterable[str], multi_line: bool = True) -> DataFrame:
    """Headered CSV export, all text, columns taken by their header names.

    The file may hold further columns and any column order; a missing one is an error.
    ``multi_line`` allows line breaks inside quoted fields, at the price of one task per
    file; turn it off for exports without them to split large files.
    """
    df = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
          .option("enforceSchema", False).csv(path))
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])
