"""Role mapping: the resolved shelter model built from the benchmark tables.

=================  ===========================================================
shelter role       benchmark source
=================  ===========================================================
animal             customer (species from the nation's region, sex from the
                   market segment, birth = first order date)
visit (intake)     orders (type from priority, outcome from status, out date
                   = last ship date of the order's lines)
intake status      orders (status P = pending, else completed)
exam condition     lineitem of the customer's orders (condition from return
                   flag and line status, date = ship date)
status history     lineitem (stage from return flag / line status, inactive
                   when tax < 0.02, date = ship date, operation = order)
location history   events (location from event type)
euthanasia         lineitem with return flag R
treatment          lineitem x part (medication from part type), site and
                   surgeon from the supplier
=================  ===========================================================

The derived columns are SQL CASE texts shared with the DuckDB oracle (``ROLE_SQL``),
so both engines read identical inputs; the report logic itself is written
independently on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.operators.joins import deal, join_large
from shelterlens.sources.model import Model
from shelterlens.sources.tables import read_driver_tables

# Fixed values of the role mapping (CASE texts valid in Spark SQL and DuckDB).
SPECIES_CASE = ("CASE n_regionkey WHEN 0 THEN 'Cat' WHEN 1 THEN 'Dog' WHEN 2 THEN 'Cat' "
                "WHEN 3 THEN 'Dog' ELSE 'Rabbit' END")
SEX_CASE = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'F' WHEN 'BUILDING' THEN 'M' "
            "WHEN 'FURNITURE' THEN 'F' WHEN 'HOUSEHOLD' THEN 'M' ELSE 'U' END")
INTAKE_TYPE_CASE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Stray' WHEN '2-HIGH' THEN 'TransferIn' "
                    "WHEN '3-MEDIUM' THEN 'OwnerSurrender' WHEN '4-NOT SPECIFIED' THEN '[Return]' "
                    "ELSE 'Transport' END")
OUTCOME_TYPE_CASE = ("CASE o_orderstatus WHEN 'F' THEN 'Adoption' WHEN 'O' THEN 'Died' "
                     "ELSE 'PreEuthanasia' END")
OPERATION_STATUS_CASE = "CASE o_orderstatus WHEN 'P' THEN 'Pending' ELSE 'Completed' END"
CONDITION_CASE = ("CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Diarrhea' "
                  "WHEN l_returnflag = 'R' AND l_discount >= 0.05 THEN 'Diarrhea, acute, nonspecific' "
                  "WHEN l_returnflag = 'R' THEN 'Parvovirus, canine' "
                  "WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Surgical complication' "
                  "WHEN l_returnflag = 'A' THEN 'Incision complications' "
                  "WHEN l_linestatus = 'F' AND l_discount >= 0.05 THEN 'Anesthetic complication' "
                  "WHEN l_linestatus = 'F' THEN 'Ringworm, confirmed' "
                  "ELSE 'URI, feline' END")
STAGE_CASE = ("CASE WHEN l_returnflag = 'A' THEN 'Evaluate' "
              "WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Surgery Needed' "
              "WHEN l_returnflag = 'N' THEN 'Foster Program' ELSE 'Post -Op' END")
STATUS_CASE = "CASE WHEN l_tax < 0.02 THEN 'I' ELSE 'A' END"
LOCATION_CASE = ("CASE event_type WHEN 'view' THEN 'Fosters' WHEN 'error' THEN 'Off Site Clinic' "
                 "WHEN 'click' THEN 'Kennel' WHEN 'signup' THEN 'Intake Room' ELSE 'Clinic' END")
LINE_LOCATION_CASE = ("CASE WHEN l_returnflag = 'R' THEN 'Kennel' "
                      "WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Clinic' "
                      "WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Off Site Clinic' ELSE 'Fosters' END")
MEDICATION_CASE = ("CASE p_type WHEN 'STANDARD' THEN 'Ovariohysterectomy' WHEN 'MEDIUM' THEN 'Orchidectomy' "
                   "WHEN 'LARGE' THEN 'Dental Extraction' WHEN 'PROMO' THEN 'Orchidectomy, cryptorchid' "
                   "WHEN 'SMALL' THEN 'Mass Removal' ELSE 'COHAT' END")
# Export files of the external clinic (all text, as read from CSV).
PROBLEMS_CASE = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Surgical complication' "
                 "WHEN 'BUILDING' THEN 'Incision complications' WHEN 'FURNITURE' THEN 'Anesthetic complication' "
                 "WHEN 'MACHINERY' THEN 'Vomiting,Surgical complication,Anesthetic arrest,Anemia' END")
PRODUCT_CASE = ("CASE p_type WHEN 'STANDARD' THEN 'Spay - Canine' WHEN 'MEDIUM' THEN 'Neuter - Feline' "
                "WHEN 'LARGE' THEN 'COHAT Level 2' WHEN 'PROMO' THEN 'Pre-Anesthetic Bloodwork, Spay' "
                "WHEN 'SMALL' THEN 'Spay TNR' ELSE 'Exam' END")
STAFF_CASE = "CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 100 THEN 'Ezy Support' ELSE s_name END"
CASE_OWNER_CASE = "CASE WHEN l_linestatus = 'O' THEN 'Owner ' || CAST(s_nationkey AS STRING) END"
BUSINESS_CASE = "CASE WHEN l_tax >= 0.08 THEN 'ezyVet Software Support' ELSE 'Main Clinic' END"
PATIENT_CASE = ("CASE WHEN l_discount >= 0.1 THEN 'TNR cat ' || CAST(o_custkey AS STRING) "
                "ELSE 'Pet ' || CAST(o_custkey AS STRING) END")
INVOICE_SPECIES_CASE = "CASE WHEN p_size < 10 THEN 'Special Species' ELSE 'Cat' END"
# A line's identity is its four keys: fixed-width text, so it sorts as the keys do and cannot overflow or collide.
LINE_ID = " || '-' || ".join(f"lpad(CAST({key} AS STRING), 19, '0')"
                             for key in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
SURGEON_LAST = "CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS STRING) END"


class LazyModel(dict):
    """A model whose frames are built on first access (a plain dict to callers)."""

    def __init__(self, builders: dict, rows=None, packed: dict | None = None):
        super().__init__()
        self._builders = builders
        self.rows = rows   # rows of a frame, without building it (``sources.model.known_rows``)
        self.packed = packed or {}   # builder of a narrower frame, and what makes the frame of it (``sources.model.packed``)

    def __missing__(self, key):
        if key not in self._builders:
            raise KeyError(key)
        value = self._builders[key]()
        self[key] = value
        return value


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax",
                "l_discount", "l_shipdate")


def model_from_driver(spark: SparkSession, sf_dir: str, line_locations: bool = False) -> Model:
    """Resolved shelter model over the benchmark parquet tables (frames built on first use).

    ``line_locations`` takes the location history from the order lines instead of
    the events, so that moves fall inside the stays (used by the stay report).
    """
    return model_from_driver_tables(read_driver_tables(spark, sf_dir), line_locations)


def model_from_driver_tables(t: dict[str, DataFrame], line_locations: bool = False) -> Model:
    orders, lineitem = t["orders"], t["lineitem"]
    # nation has 25 rows by definition of the schema: a bounded broadcast.
    nation = F.broadcast(t["nation"].select("n_nationkey", "n_regionkey", "n_name"))
    cache: dict = {}

    def rows(table: str) -> int:
        if table not in cache:
            cache[table] = t[table].count()   # from the files' footers
        return cache[table]

    def lines() -> DataFrame:
        # Order lines with their customer. A report reads at most two roles built on
        # this join, so it is left to the plan (each use prunes its own columns)
        # rather than written out: a write + two reads costs about what a second
        # join does, and one-role reports would pay the write for nothing.
        if "lines" not in cache:
            ordered = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
            cache["lines"] = join_large(*[deal(x, ["l_orderkey"], rows("lineitem"), joined=True)
                                          for x in (lineitem.select(*LINE_COLUMNS), ordered)], "l_orderkey")
        return cache["lines"]

    def animals() -> DataFrame:
        first_order = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min("o_orderdate").alias("DateOfBirth"))
        customer = t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        return (join_large(customer, first_order, "c_custkey", "left")
                .select(F.col("c_custkey").alias("AnimalID"), F.col("c_name").alias("Name"),
                        F.expr(SPECIES_CASE).alias("Species"), F.expr(SEX_CASE).alias("Sex"),
                        "DateOfBirth", F.lit(True).alias("has_details")))

    def visits() -> DataFrame:
        return orders.select(F.col("o_orderkey").alias("InPrimaryKey"), F.col("o_custkey").alias("AnimalID"),
                             F.col("o_orderdate").alias("tin_DateCreated"),
                             F.expr(INTAKE_TYPE_CASE).alias("IntakeType"),
                             F.col("o_orderpriority").alias("IntakeSubType"),
                             F.expr(OUTCOME_TYPE_CASE).alias("OutComeType"))

    def visits_out() -> DataFrame:
        last_ship = lineitem.groupBy(F.col("l_orderkey").alias("InPrimaryKey")).agg(
            F.max("l_shipdate").alias("tOut_DateCreated"))
        return join_large(*[deal(x, ["InPrimaryKey"], rows("orders"), joined=True) for x in (visits(), last_ship)],
                          "InPrimaryKey", "left")

    def intake_status() -> DataFrame:
        return orders.select(F.col("o_orderkey").alias("OperationRecordID"),
                             F.col("o_orderdate").alias("StatusDateTime"),
                             F.expr(OPERATION_STATUS_CASE).alias("OperationStatus"))

    def condition_lines() -> DataFrame:
        return lines().select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("AnimalID"),
                              F.expr(CONDITION_CASE).alias("Condition"), F.col("l_shipdate").alias("DateTimeDiagnosed"))

    def with_condition_ids(df: DataFrame) -> DataFrame:
        return (df.withColumns({"ExamConditionID": F.expr(LINE_ID), "DateCreated": F.col("DateTimeDiagnosed")})
                .withColumnRenamed("l_orderkey", "ExamID").drop("l_linenumber", "l_partkey", "l_suppkey"))

    def exam_conditions() -> DataFrame:
        return with_condition_ids(condition_lines()).select("ExamConditionID", "ExamID", "AnimalID", "Condition",
                                                            "DateCreated", "DateTimeDiagnosed")

    def statuses() -> DataFrame:
        return lines().select(F.col("o_custkey").alias("AnimalID"), F.expr(STAGE_CASE).alias("Stage"),
                              F.expr(STATUS_CASE).alias("Status"), F.col("l_shipdate").alias("LastUpdated"),
                              F.col("l_orderkey").alias("OperationPrimaryID"))

    def locations() -> DataFrame:
        if line_locations:
            return lines().select(F.col("o_custkey").alias("AnimalID"), F.expr(LINE_LOCATION_CASE).alias("Location"),
                                  F.col("l_shipdate").alias("LastUpdated"))
        return t["events"].select(F.col("user_id").alias("AnimalID"), F.expr(LOCATION_CASE).alias("Location"),
                                  F.col("ts").alias("LastUpdated"))

    def euthanasia() -> DataFrame:
        return lines().where(F.col("l_returnflag") == "R").select(
            F.col("o_custkey").alias("AnimalID"), F.col("l_shipdate").alias("DateCreated"))

    def treatment_lines() -> DataFrame:
        supplier = (t["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
                    .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("SiteName"),
                            F.concat(F.col("s_name"), F.lit(" "), F.expr(SURGEON_LAST)).alias("SurgeonName")))
        part = t["part"].select(F.col("p_partkey").alias("l_partkey"), F.expr(MEDICATION_CASE).alias("Medication"))
        return (lines().join(part, "l_partkey", "inner").join(supplier, "l_suppkey", "inner")
                .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("AnimalID"),
                        "Medication", F.col("l_shipdate").alias("StatusDateTime"),
                        F.col("o_orderdate").alias("DateCreated"), "SiteName", "SurgeonName"))

    def with_treatment_ids(df: DataFrame) -> DataFrame:
        return (df.withColumns({"ExamTreatmentID": F.expr(LINE_ID), "AssistantName": F.col("SurgeonName")})
                .withColumnsRenamed({"l_orderkey": "ExamID", "l_partkey": "TreatmentID"}).drop("l_linenumber", "l_suppkey"))

    def treatments() -> DataFrame:
        return with_treatment_ids(treatment_lines()).select(
            "ExamTreatmentID", "ExamID", "AnimalID", "TreatmentID", "Medication", "StatusDateTime", "DateCreated",
            "SiteName", "SurgeonName", "AssistantName")

    return LazyModel({
        "animals": animals, "visits": visits, "visits_out": visits_out, "intake_status": intake_status,
        "exam_conditions": exam_conditions, "statuses": statuses, "locations": locations,
        "euthanasia": euthanasia, "treatments": treatments,
    }, lambda frame: rows({"statuses": "lineitem", "visits": "orders"}[frame]),
        {"treatments": (treatment_lines, with_treatment_ids), "exam_conditions": (condition_lines, with_condition_ids)})


def exports_from_driver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two clinic export tables (animals, invoices) as all-text frames."""
    t = read_driver_tables(spark, sf_dir, ("customer", "nation", "orders", "lineitem", "part", "supplier"))
    nation = F.broadcast(t["nation"].select("n_nationkey", "n_regionkey"))  # 25 rows
    animals = (t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
               .select(F.col("c_custkey").cast("string").alias("Animal Code"), F.col("c_name").alias("Animal Name"),
                       F.expr(SPECIES_CASE).alias("Species"), F.lit("Owner").alias("Owner First Name"),
                       F.col("c_nationkey").cast("string").alias("Owner Last Name"),
                       F.expr(PROBLEMS_CASE).alias("Master Problems"),
                       F.lit(None).cast("string").alias("Last Visit")))
    lines = (t["lineitem"].join(t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
                                "l_orderkey", "inner")
             .join(t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size"), "l_partkey", "inner")
             .join(t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_acctbal", "s_nationkey"),
                   "l_suppkey", "inner"))
    invoices = lines.select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("Invoice Date"),
        F.col("l_returnflag").alias("Department"), F.expr(BUSINESS_CASE).alias("Business Name"),
        F.col("o_custkey").cast("string").alias("Animal Code"), F.expr(PATIENT_CASE).alias("Patient Name"),
        F.expr(INVOICE_SPECIES_CASE).alias("Species"), F.expr(PRODUCT_CASE).alias("Product Name"),
        F.expr(STAFF_CASE).alias("Staff Member"), F.expr(CASE_OWNER_CASE).alias("Case Owner"))
    return animals, invoices


# The same mapping as DuckDB SQL views, prefixed to every oracle query.
ROLE_SQL = f"""
first_order AS (SELECT o_custkey AS c_custkey, min(o_orderdate) AS DateOfBirth FROM orders GROUP BY o_custkey),
animals AS (
  SELECT c.c_custkey AS AnimalID, c.c_name AS Name, {SPECIES_CASE} AS Species, {SEX_CASE} AS Sex,
         f.DateOfBirth, TRUE AS has_details
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN first_order f ON f.c_custkey = c.c_custkey),
visits AS (
  SELECT o_orderkey AS InPrimaryKey, o_custkey AS AnimalID, o_orderdate AS tin_DateCreated,
         {INTAKE_TYPE_CASE} AS IntakeType, o_orderpriority AS IntakeSubType, {OUTCOME_TYPE_CASE} AS OutComeType
  FROM orders),
last_ship AS (SELECT l_orderkey AS InPrimaryKey, max(l_shipdate) AS tOut_DateCreated FROM lineitem GROUP BY l_orderkey),
visits_out AS (SELECT v.*, s.tOut_DateCreated FROM visits v LEFT JOIN last_ship s ON s.InPrimaryKey = v.InPrimaryKey),
intake_status AS (
  SELECT o_orderkey AS OperationRecordID, o_orderdate AS StatusDateTime, {OPERATION_STATUS_CASE} AS OperationStatus
  FROM orders),
lines AS (SELECT l.*, o.o_custkey, o.o_orderdate FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
exam_conditions AS (
  SELECT {LINE_ID} AS ExamConditionID, l_orderkey AS ExamID, o_custkey AS AnimalID, {CONDITION_CASE} AS Condition,
         l_shipdate AS DateCreated, l_shipdate AS DateTimeDiagnosed
  FROM lines),
statuses AS (
  SELECT o_custkey AS AnimalID, {STAGE_CASE} AS Stage, {STATUS_CASE} AS Status, l_shipdate AS LastUpdated,
         l_orderkey AS OperationPrimaryID
  FROM lines),
line_locations AS (SELECT o_custkey AS AnimalID, {LINE_LOCATION_CASE} AS Location, l_shipdate AS LastUpdated FROM lines),
locations AS (SELECT user_id AS AnimalID, {LOCATION_CASE} AS Location, ts AS LastUpdated FROM events),
euthanasia AS (SELECT o_custkey AS AnimalID, l_shipdate AS DateCreated FROM lines WHERE l_returnflag = 'R'),
animals_csv AS (
  SELECT CAST(c_custkey AS STRING) AS "Animal Code", c_name AS "Animal Name", {SPECIES_CASE} AS Species,
         'Owner' AS "Owner First Name", CAST(c_nationkey AS STRING) AS "Owner Last Name",
         {PROBLEMS_CASE} AS "Master Problems", CAST(NULL AS STRING) AS "Last Visit"
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
invoices_csv AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "Invoice Date", l_returnflag AS Department,
         {BUSINESS_CASE} AS "Business Name", CAST(o_custkey AS STRING) AS "Animal Code", {PATIENT_CASE} AS "Patient Name",
         {INVOICE_SPECIES_CASE} AS Species, {PRODUCT_CASE} AS "Product Name", {STAFF_CASE} AS "Staff Member",
         {CASE_OWNER_CASE} AS "Case Owner"
  FROM lines JOIN part p ON p.p_partkey = lines.l_partkey JOIN supplier s ON s.s_suppkey = lines.l_suppkey),
treatments AS (
  SELECT {LINE_ID} AS ExamTreatmentID, l_orderkey AS ExamID, o_custkey AS AnimalID, l_partkey AS TreatmentID,
         {MEDICATION_CASE} AS Medication, l_shipdate AS StatusDateTime, o_orderdate AS DateCreated,
         n.n_name AS SiteName, s.s_name || ' ' || ({SURGEON_LAST}) AS SurgeonName,
         s.s_name || ' ' || ({SURGEON_LAST}) AS AssistantName
  FROM lines JOIN part p ON p.p_partkey = lines.l_partkey
  JOIN supplier s ON s.s_suppkey = lines.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey)
"""


def with_roles(body: str) -> str:
    """Oracle SQL: the role views followed by ``body`` (which may add CTEs after a comma)."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ROLE_SQL.strip() + ",\n" + body[5:]
    return "WITH " + ROLE_SQL.strip() + "\n" + body
