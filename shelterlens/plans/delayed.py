"""Delayed outcome list (C15): euthanasia 4-21 days after an intake.

For each report month, euthanasia records of the previous month are paired with
intakes of the same animal ``lo..hi`` day boundaries earlier; per animal only
the pairs at the minimum day count are kept (ties kept), then one row per
(animal, intake day): the earliest intake and the earliest euthanasia.

Linear form: visits and euthanasia records are first reduced to one row per
(animal, day), the visit days are offset by each allowed count (``hi - lo + 1``
rows) and equi-joined on (animal, day); no visit x euthanasia product.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, month_start
from shelterlens.operators.dedupe import keep_min_ties
from shelterlens.operators.joins import join_large
from shelterlens.operators.spine import MonthSpine, _add_months
from shelterlens.sources.model import Model

# Fixed values of the delayed-outcome report.
SPECIES = ("Cat", "Dog")
INTAKE_TYPES = ("TransferIn", "OwnerSurrender", "Stray", "[Return]")
MIN_DAYS, MAX_DAYS = 4, 21


def delayed_outcome(m: Model, spine: MonthSpine, lo: int = MIN_DAYS, hi: int = MAX_DAYS) -> DataFrame:
    animals = (m["animals"].where(F.col("has_details") & F.col("Species").isin(list(SPECIES)))
               .select("AnimalID", "Name", "Species", "DateOfBirth", "Sex"))
    # literal bounds for the scans: records of the months before the report months, intakes up to hi days earlier
    begin, end = _add_months(spine.first, -1), spine.last
    eu = (m["euthanasia"].where((F.col("DateCreated") >= as_timestamp(F.lit(begin)))
                                & (F.col("DateCreated") < as_timestamp(F.lit(end))))
          .withColumn("ReportDate", F.add_months(month_start("DateCreated"), 1))
          .where(spine.in_spine("ReportDate"))
          .groupBy("AnimalID", F.to_date("DateCreated").alias("_eday"), "ReportDate")
          .agg(F.min("DateCreated").alias("EuthanizedDate")))
    v = (m["visits"].where(F.col("IntakeType").isin(list(INTAKE_TYPES)))
         .where((F.col("tin_DateCreated") >= as_timestamp(F.lit(begin - _dt.timedelta(days=hi))))
                & (F.col("tin_DateCreated") < as_timestamp(F.lit(end))))
         .groupBy("AnimalID", F.to_date("tin_DateCreated").alias("_vday"))
         .agg(F.min(F.struct(F.col("tin_DateCreated").alias("t"), F.col("IntakeType").alias("k"))).alias("_first")))
    shifted = (v.withColumn("TimetoEuth", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
               .withColumn("_eday", F.date_add("_vday", F.col("TimetoEuth"))))
    pairs = join_large(join_large(eu, shifted, ["AnimalID", "_eday"]), animals.select("AnimalID"), "AnimalID", "left_semi")
    # at most (days of a month) x (allowed day counts) rows per animal and month: a bounded window
    best = keep_min_ties(pairs, ["AnimalID", "ReportDate"], "TimetoEuth")
    out = join_large(best, animals, "AnimalID")
    return out.select("AnimalID", "Name", "Species", "DateOfBirth", "Sex",
                      F.col("_first.k").alias("IntakeType"), F.col("_first.t").alias("IntakeDate"),
                      "EuthanizedDate", F.col("TimetoEuth").cast("bigint").alias("TimetoEuth"), "ReportDate")
