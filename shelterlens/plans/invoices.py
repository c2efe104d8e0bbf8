"""External clinic invoices (C16): surgery invoices classified and enriched with
the animal's problem list, then the complication share per surgery type.

Inputs are the two CSV exports read with ``sources.tables.read_export_csv``
(all columns as text). The per-(animal, surgery type) de-duplication keeps the
earliest invoice (the report keeps file order, which a distributed read does not
have; ties are then broken by every column, Q13).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.functions.predicates import contains_regex, last_rule_wins, ne_keep_null, regex_exclude
from shelterlens.operators.dedupe import Ord, keep_first
from shelterlens.plans.surgery import type_share

# Fixed values of the invoice report (patterns are used as the report writes them).
ANIMAL_COLUMNS = ("Animal Code", "Animal Name", "Species", "Owner First Name", "Owner Last Name",
                  "Master Problems", "Last Visit")
INVOICE_COLUMNS = ("Invoice Date", "Department", "Business Name", "Animal Code", "Patient Name", "Species",
                   "Product Name", "Staff Member", "Case Owner")
ANIMAL_NAME_EXCLUDE = ("^Queensv.*", "^TNR.*", "TNR.*")
PATIENT_NAME_EXCLUDE = ("^TNR.*", "TNR.*")
SURGERY_RULES = (("Spay.*", "Spay"), ("COHAT.*", "Dental"), ("Neuter.*", "Neuter"))
SUPPORT_STAFF = "Ezy Support"
SUPPORT_BUSINESS = "ezyVet Software Support"
NO_PROBLEMS = "No Complications"
COMP_RULES = (
    ("Surgical complication", "SIC"),
    ("Incision complications", "SIC"),
    ("Surgical complication,Pyometra,Dehiscence, dental,COHAT 1-2", "Multiple"),
    ("Vomiting,Surgical complication,Anesthetic arrest,Anemia", "Multiple"),
    ("Vomiting,Surgical complication,Arrest, anesthetic,Anemia", "Multiple"),
    ("Anesthetic complication", "Anest"),
    ("No Complications", "No Comp"),
)
TNR_ANY_CASE = "tnr|tnR|tNr|tNR|Tnr|TnR|TNr|TNR*"
PRE_ANESTHETIC = "Pre-Anesthetic*"
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "MM/dd/yyyy HH:mm",
                "MM/dd/yyyy", "M/d/yyyy")


def parsed_date(text, formats=DATE_FORMATS):
    """Zone-less time of a text by the first format that fits; null and blank stay null, other text is an error."""
    c = F.col(text) if isinstance(text, str) else text
    t = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")
    bad = c.isNotNull() & (F.trim(c) != "") & t.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("no known date format: "), c)).cast("timestamp_ntz")).otherwise(t)


def invoice_complications(animals: DataFrame, invoices: DataFrame, date_formats=DATE_FORMATS) -> DataFrame:
    a = animals.select(*[F.col(f"`{c}`") for c in ANIMAL_COLUMNS])
    for p in ANIMAL_NAME_EXCLUDE:
        a = a.where(regex_exclude(F.col("`Animal Name`"), p))
    a = a.where(F.col("`Master Problems`").isNotNull())
    d = invoices.select(*[F.col(f"`{c}`") for c in INVOICE_COLUMNS])
    d = d.withColumn("Invoice Date", parsed_date(F.col("`Invoice Date`"), date_formats))
    for p in PATIENT_NAME_EXCLUDE:
        d = d.where(regex_exclude(F.col("`Patient Name`"), p))
    d = (d.withColumn("Staff Member", F.coalesce(F.col("`Staff Member`"), F.col("`Case Owner`")))
         .where(F.col("`Staff Member`").isNotNull()).drop("Case Owner"))
    product = F.col("`Product Name`")
    d = d.withColumn("SurgeryType", last_rule_wins([(contains_regex(product, p), v) for p, v in SURGERY_RULES],
                                                   "Other"))
    d = (d.where(F.col("SurgeryType") != "Other")
         .where(ne_keep_null(F.col("`Staff Member`"), SUPPORT_STAFF))
         .where(ne_keep_null(F.col("`Business Name`"), SUPPORT_BUSINESS)))
    d = keep_first(d, ["Animal Code", "SurgeryType"],
                   [Ord("Invoice Date")] + [Ord(c) for c in ("Department", "Business Name", "Patient Name",
                                                             "Species", "Product Name", "Staff Member")])
    out = d.join(a.select("Animal Code", "Master Problems"), "Animal Code", "left")
    problems = F.coalesce(F.col("`Master Problems`"), F.lit(NO_PROBLEMS))
    out = (out.withColumn("Master Problems", problems)
           .withColumnRenamed("Invoice Date", "Date").withColumnRenamed("Staff Member", "All Resources / Vets"))
    mp = F.col("`Master Problems`")
    out = out.withColumn("Comp", last_rule_wins([(mp == F.lit(t), v) for t, v in COMP_RULES], "Others"))
    out = (out.where(regex_exclude(F.col("`Patient Name`"), TNR_ANY_CASE))
           .where(regex_exclude(product, TNR_ANY_CASE))
           .where(regex_exclude(product, PRE_ANESTHETIC)))
    return out.select("Date", "Department", "Business Name", "Animal Code", "Patient Name", "Species",
                      "Product Name", "All Resources / Vets", "SurgeryType", "Master Problems", "Comp")


def invoice_share(invoices: DataFrame, as_of: _dt.date) -> DataFrame:
    """C10 on invoices: share of Comp / No Comp per (species group, surgery type, month)."""
    typed = invoices.withColumn("Type", F.when(F.col("Comp") == "No Comp", F.lit("No Comp"))
                                .otherwise(F.lit("Comp")))
    return type_share(typed, "SurgeryType", as_of, date_col="Date")


def report_numerator(invoices: DataFrame) -> DataFrame:
    """C17: rows with a problem list (pandas ``!=``: NULL kept)."""
    return invoices.where(ne_keep_null(F.col("`Master Problems`"), NO_PROBLEMS))
