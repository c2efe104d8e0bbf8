"""Surgical complication reports (C7-C10) and the dental variant.

Per report month: surgeries (denominator), surgery x complication pairs within
``-2`` days (numerator), both de-duplicated with explicit total orders, stacked
with "Comp wins" (C9) and summarised as a percent grid (C10).

The surgery x complication rule is answered without listing all pairs: a
surgery can only pair with a complication of condition C if its day is at most
two days after the latest such complication of the animal that month, so the
first pair in (surgery id, complication id) order comes from the smallest
eligible surgery id and only those few candidates meet the complication rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp, month_end_midnight, month_start, ntz_micros
from shelterlens.functions.predicates import case_in_lists, ne_keep_null
from shelterlens.operators.dedupe import Ord, flag_group_size, keep_first, keep_min_ties
from shelterlens.operators.joins import ROWS_A_TASK, crowded, deal, join_in_place, join_large
from shelterlens.session import materialize, materialize_dealt
from shelterlens.operators.spine import MonthSpine, observed_grid, trailing_months
from shelterlens.sources.model import Model, packed

# Surgery lists, category rules and complication lists of the reports.
SURGERY_MEDICATIONS = (
    "Urethrostomy, Perineal", "Amputation, Digit", "Amputation, Tail", "Orchidectomy Intra-Ab Crytorch",
    "Orchidectomy Inguinal", "Amputation, Hind Leg", "Laceration (minor)", "Rectal Prolapse Repair", "Amputation",
    "Biopsy", "Cherry eye repair", "Cruciate Ligament Repair", "Cystotomy", "Dental Dehiscence Repair",
    "Dental Extraction", "Dental COHAT (Lv 1-3)", "Dental COHAT (Lv 4-5)", "Dental Extraction, Difficult",
    "Ectropion correction", "Entropion Correction", "Enucleation", "Esophagostomy tube placement",
    "Exploratory Laparotomy", "Femoral head ostectomy", "Fracture repair", "Hernia repair", "Incision repair",
    "Mass Removal", "Orchidectomy", "Orchidectomy, cryptorchid", "Ovariohysterectomy", "Patella Luxation Surgery",
    "Total ear canal ablation", "Total hip replacement", "TPLO")
COMPLICATION_MEDICATIONS = SURGERY_MEDICATIONS + ("COHAT",)
DENTAL_MEDS = ("Dental Dehiscence Repair", "Dental Extraction", "Dental COHAT (Lv 1-3)", "Dental COHAT (Lv 4-5)",
               "Dental Extraction, Difficult")
NEUTER_MEDS_DENOMINATOR = ("Orchidectomy", "Orchidectomy, cryptorchid", "Orchidectomy Intra-Ab Crytorch",
                           "Orchidectomy Inguinal")
NEUTER_MEDS_NUMERATOR = ("Orchidectomy", "Orchidectomy, cryptorchid", "Orchidectomy Inguinal")
SPAY_MEDS = ("Ovariohysterectomy",)
COMPLICATIONS = ("Incision complications", "Surgical complication", "Anesthetic complication", "Anesthetic arrest")
DENTAL_SURGERIES = DENTAL_MEDS + ("COHAT",)
DENTAL_COMPLICATIONS = ("Dehiscence, dental", "Ranula", "Incision complications", "Surgical complication")
DENTAL_REPAIR = "Dental Dehiscence Repair"
OFF_SITE = "Off Site Clinic"


@dataclass(frozen=True)
class SurgeryConfig:
    name: str
    den_medications: tuple
    num_medications: tuple
    complications: tuple
    den_category: tuple            # ((medications, label), ...), else 'Other'
    num_category: tuple
    group_species: bool = True     # Cat / Dog / Special Species
    infer_sex: bool = True         # U + spay/neuter -> F/M
    drop_medication: str | None = None   # dental: repair rows removed
    collapse_multiple: str | None = None  # dental: one row per animal-day, relabelled
    gap_filter: bool = False             # dental: previous-row gap filter (W6, Q8)
    gap_per_animal: bool = False         # repaired variant: previous row of the same animal


GENERAL = SurgeryConfig(
    "all", SURGERY_MEDICATIONS, COMPLICATION_MEDICATIONS, COMPLICATIONS,
    ((DENTAL_MEDS, "Dental"), (NEUTER_MEDS_DENOMINATOR, "Neuter"), (SPAY_MEDS, "Spay")),
    ((DENTAL_MEDS, "Dental"), (NEUTER_MEDS_NUMERATOR, "Neuter"), (SPAY_MEDS, "Spay")))
DENTAL = SurgeryConfig(
    "dental", DENTAL_SURGERIES, DENTAL_SURGERIES, DENTAL_COMPLICATIONS,
    ((DENTAL_SURGERIES, "Dental"),), ((DENTAL_SURGERIES, "Dental"),),
    group_species=False, infer_sex=False, drop_medication=DENTAL_REPAIR, collapse_multiple="Dental",
    gap_filter=True)
SURGERY_GAP_DAYS = 1
ANIMAL_RANGE = 1 << 16   # ids of one range of the gap filter: at most so many rows in one window
COMPLICATION_GAP_HOURS = 72

SURGERY_TIEBREAK = ("SurgeryID", "SurgeonName", "AssistantName", "Site", "SiteName")


def species_group(c: Column) -> Column:
    return (F.when(c == "Cat", F.lit("Cat")).when(c == "Dog", F.lit("Dog"))
            .when(~c.isin("Dog", "Cat"), F.lit("Special Species")))


def inferred_sex(sex: Column, med: Column) -> Column:
    return (F.when((sex == "U") & (med == "Ovariohysterectomy"), F.lit("F"))
            .when((sex == "U") & (med == "Orchidectomy"), F.lit("M"))
            .when(sex == "F", F.lit("F")).when(sex == "M", F.lit("M")).otherwise(sex))


def site_label(site_name: Column, site_groups: Sequence) -> Column:
    return case_in_lists(site_name, site_groups) if site_groups else F.lit(None).cast("string")


def _in_month(df: DataFrame, ts: str, spine: MonthSpine) -> DataFrame:
    """``ts BETWEEN month start AND 00:00 of its last day`` for a report month."""
    df = df.where((F.col(ts) >= as_timestamp(F.lit(spine.first))) & (F.col(ts) <= month_end_midnight(F.lit(spine.last))))
    df = df.withColumn("reference_date", month_start(ts)).where(spine.in_spine("reference_date"))
    return df.where(F.col(ts) <= month_end_midnight("reference_date"))


def animal_location(m: Model) -> DataFrame:
    """Per animal: number of location rows and the earliest non-off-site one (Q22)."""
    loc = m["locations"]
    ok = ne_keep_null("Location", OFF_SITE)
    first = F.min(F.when(ok, F.struct(F.col("LastUpdated").isNull().alias("n"), F.col("LastUpdated").alias("d"),
                                      F.col("Location").alias("l"))))
    return (loc.groupBy("AnimalID")
            .agg(F.count(F.lit(1)).alias("_nloc"), F.max(ok.cast("int")).alias("_nok"), first.alias("_first"))
            .select("AnimalID", "_nloc", "_nok", F.col("_first.l").alias("Location"),
                    F.col("_first.d").alias("LocationDate")))


def _with_location(df: DataFrame, m: Model) -> DataFrame:
    """Row-wise off-site removal over the location fan-out: an animal's rows survive
    unless all its location rows are off-site; the kept location is the earliest."""
    out = join_large(df, animal_location(m), "AnimalID", "left")
    return out.where(F.col("_nloc").isNull() | (F.col("_nok") == 1)).drop("_nloc", "_nok")


@dataclass(frozen=True)
class Treatments:
    """Treatment rows with their animal and location, dealt by ``by`` over ``tasks`` tasks."""
    rows: DataFrame
    by: tuple
    tasks: int


def treatment_rows(m: Model, spine: MonthSpine, meds: Sequence[str], location: bool = True,
                   stored: bool = False) -> Treatments:
    """Treatments of ``meds`` in the report months with their animal and location: what surgeries and complications
    both start from. They are written once without what follows from their other columns (``packed``), dealt by animal
    and joined with the animals there; every later step is within an animal's month, so nothing is shuffled again.
    An animal with so many treatments that it would crowd a task (``crowded``) makes all of them dealt by animal and
    month instead, after the join. ``location=False`` leaves the kept location's columns null, for results without
    them; ``stored`` keeps the dealt rows, for callers that read them more than once."""
    t, unpack = packed(m, "treatments")
    t = t.where(F.col("Medication").isin(list(meds)) & F.col("AnimalID").isNotNull())
    t = materialize(_in_month(t, "StatusDateTime", spine).drop("reference_date", "TreatmentID"))
    n = t.count()
    animals = m["animals"].where(F.col("has_details")).select("AnimalID", "Name", "Species", "Sex", "DateOfBirth")
    animals = _with_location(animals, m)
    if not location:
        animals = animals.withColumns({c: F.lit(None).cast(animals.schema[c].dataType) for c in ("Location", "LocationDate")})
    tasks, by = n // ROWS_A_TASK + 1, ("AnimalID",)
    if crowded([t], by, tasks):
        by = ("AnimalID", "reference_date")
        rows = materialize(join_large(t, animals, "AnimalID").withColumn("reference_date", month_start("StatusDateTime")))
        return Treatments(unpack(deal(rows, by, n)), by, tasks)
    animals = materialize_dealt(deal(animals, by, n), by, tasks)
    rows = join_large(deal(t, by, n), animals, "AnimalID").withColumn("reference_date", month_start("StatusDateTime"))
    return Treatments(unpack(materialize_dealt(rows, by, tasks) if stored else rows), by, tasks)


def _surgery_base(rows: DataFrame, meds: Sequence[str], category: Sequence, cfg: SurgeryConfig,
                  site_groups: Sequence, ranked: bool) -> DataFrame:
    t = rows.where(F.col("Medication").isin(list(meds)))
    if ranked:
        t = with_surgery_rank(t)
    med = F.col("Medication")
    return t.select(
        "AnimalID", "Name",
        (species_group(F.col("Species")) if cfg.group_species else F.col("Species")).alias("Species"),
        (inferred_sex(F.col("Sex"), med) if cfg.infer_sex else F.col("Sex")).alias("Sex"),
        "DateOfBirth", F.col("ExamTreatmentID").alias("UniqueSurgeryID"), F.col("ExamID").alias("SurgeryID"),
        med.alias("SurgeryType"), case_in_lists(med, category, "Other").alias("SurgeryCategory"),
        F.col("StatusDateTime").alias("SurgeryTs"), F.to_date("DateCreated").alias("_sday"),
        "SurgeonName", "AssistantName", site_label(F.col("SiteName"), site_groups).alias("Site"), "SiteName",
        "reference_date", "Location", "LocationDate", *(["Rank"] if ranked else []))


def surgeries(m: Model, spine: MonthSpine, cfg: SurgeryConfig = GENERAL, site_groups: Sequence = (),
              rows: Treatments | None = None, ranked: bool = True) -> DataFrame:
    """Surgeries per month, one per treatment and per (animal, type, day); ``Multiple``
    when an exam has more than one surgery that day.

    ``rows``: treatment rows that are at hand already; ``ranked=False`` leaves out ``Rank``.
    """
    rows = treatment_rows(m, spine, cfg.den_medications) if rows is None else rows
    s = _surgery_base(rows.rows, cfg.den_medications, cfg.den_category, cfg, site_groups, ranked)
    if cfg.drop_medication:
        s = s.where(ne_keep_null("SurgeryType", cfg.drop_medication))
    s = s.drop("_sday")
    tb = [Ord(c) for c in SURGERY_TIEBREAK]
    s = keep_first(s, ["AnimalID", "UniqueSurgeryID", "reference_date"], [Ord("SurgeryTs"), Ord("SurgeryType")] + tb)
    s = s.withColumn("SurgeryDate", F.to_date("SurgeryTs"))
    s = keep_first(s, ["AnimalID", "SurgeryType", "SurgeryDate", "reference_date"],
                   [Ord("SurgeryTs"), Ord("UniqueSurgeryID")] + tb)
    # surgeries of one exam on one day: a group bounded by the grain, so a window count
    s = flag_group_size(s, ["AnimalID", "SurgeryDate", "SurgeryID", "reference_date"], "_n")
    s = (s.withColumn("SurgeryCategory_refined",
                      F.when(F.col("_n") > 1, F.lit("Multiple")).otherwise(F.col("SurgeryCategory")))
         .withColumn("num_surg_mapping", F.col("_n")).drop("_n"))
    if cfg.collapse_multiple:
        # an animal's surgeries of one day are few: a window, which reads the rows once
        day = ["AnimalID", "SurgeryDate", "reference_date"]
        order = ["SurgeryID", "SurgeryTs", "UniqueSurgeryID", "SurgeryType", *SURGERY_TIEBREAK[1:]]
        order += [c for c in s.columns if c not in day and c not in order]
        multiple = F.col("SurgeryCategory_refined") == "Multiple"
        first = Window.partitionBy(*day, multiple).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        s = (s.withColumn("_nth", F.row_number().over(first)).where(~multiple | (multiple & (F.col("_nth") == 1)))
             .withColumn("SurgeryCategory_refined", F.when(multiple, F.lit(cfg.collapse_multiple))
                         .otherwise(F.col("SurgeryCategory_refined"))))
        s = s.drop("Location", "LocationDate", "num_surg_mapping", "_nth")
    return s.drop("SurgeryTs")


def surgical_complications(m: Model, spine: MonthSpine, cfg: SurgeryConfig = GENERAL, site_groups: Sequence = (),
                           rows: Treatments | None = None, ranked: bool = True) -> DataFrame:
    """Complications within -2 days of a surgery in the same month; one row per
    (animal, type, complication), then the minimum days-after per (animal, complication).

    ``rows`` and ``ranked`` as in ``surgeries``.
    """
    rows = treatment_rows(m, spine, cfg.num_medications) if rows is None else rows
    s = _surgery_base(rows.rows, cfg.num_medications, cfg.num_category, cfg, site_groups, ranked).drop("Location", "LocationDate")
    if cfg.drop_medication:
        s = s.where(ne_keep_null("SurgeryType", cfg.drop_medication))
    by, keys = rows.by, ["AnimalID", "reference_date"]
    c = _complications(m, spine, cfg, rows)
    latest = c.groupBy(*keys, "SxComp").agg(F.max("_cday").alias("_maxc"))
    elig = (join_in_place(s, latest, by, [k for k in keys if k not in by])
            .where(F.date_sub("_sday", 2) <= F.col("_maxc")).drop("_maxc"))
    grp = keys + ["SurgeryType", "SxComp"]
    cand = keep_min_ties(elig, grp, "UniqueSurgeryID")
    pairs = (join_in_place(cand, c, by, [k for k in (*keys, "SxComp") if k not in by])
             .where(F.col("_cday") >= F.date_sub("_sday", 2))
             .withColumn("DaysAfterSurgery", F.datediff("_cday", "_sday")).drop("_cday", "_sday"))
    order = [Ord("UniqueCompID"), Ord("SurgeryTs"), Ord("CompDate"), Ord("DaysAfterSurgery")] + \
        [Ord(x) for x in SURGERY_TIEBREAK]
    first = keep_first(pairs, grp, order)
    if cfg.gap_filter:
        first = previous_row_gap_filter(materialize(first), cfg.gap_per_animal)   # read twice
    out = keep_min_ties(first, ["AnimalID", "reference_date", "SxComp"], "DaysAfterSurgery")
    out = out.withColumn("SurgeryDate", F.to_date("SurgeryTs")).withColumn("CompDate", F.to_date("CompDate"))
    out = flag_group_size(out, ["AnimalID", "SxComp", "SurgeryDate", "reference_date"], "_n")
    out = out.withColumn("SurgeryCategory_refined",
                         F.when(F.col("_n") > 1, F.lit("Multiple")).otherwise(F.col("SurgeryCategory")))
    return out.drop("_n", "SurgeryTs")


def _complications(m: Model, spine: MonthSpine, cfg: SurgeryConfig, rows: Treatments) -> DataFrame:
    """Complications of the report months, stored where the treatments of their animal are dealt (read twice)."""
    c, unpack = packed(m, "exam_conditions")
    c = c.where(F.col("Condition").isin(list(cfg.complications)) & F.col("AnimalID").isNotNull())
    c = _in_month(c, "DateTimeDiagnosed", spine)
    c = unpack(materialize_dealt(c.repartition(rows.tasks, *rows.by), rows.by, rows.tasks))
    return c.select("AnimalID", "reference_date", F.col("Condition").alias("SxComp"),
                    F.col("DateTimeDiagnosed").alias("CompDate"), F.col("ExamConditionID").alias("UniqueCompID"),
                    F.to_date("DateCreated").alias("_cday"))


def with_surgery_rank(t: DataFrame) -> DataFrame:
    """Adds ``Rank``, the place of each treatment among those of its (animal, medication, report
    month) by time, then id - a total order, where the original numbers rows multiplied by the
    location history in no stated order. The partition is one animal's surgeries of one kind in a month."""
    w = Window.partitionBy("AnimalID", "Medication", "reference_date").orderBy("StatusDateTime", "ExamTreatmentID")
    return t.withColumn("Rank", F.row_number().over(w))


def surgery_rank(m: Model, spine: MonthSpine, meds: Sequence[str] = SURGERY_MEDICATIONS) -> DataFrame:
    """``ROW_NUMBER`` of each surgery per (animal, medication) by time within a report month."""
    t = _in_month(m["treatments"].where(F.col("Medication").isin(list(meds))), "StatusDateTime", spine)
    return with_surgery_rank(t).select("ExamTreatmentID", "AnimalID", "Medication", "StatusDateTime",
                                       "reference_date", "Rank")


def previous_row_gap_filter(df: DataFrame, per_animal: bool = False) -> DataFrame:
    """Keep a row only if its surgery day is more than one day after the
    previous row's, or its complication time more than 72 hours after it.

    The report compares with the previous row of the whole month in the order
    (animal, type, complication, surgery date, complication time), so rows of
    different animals are compared and the first row of a month is always
    dropped; that is the default. ``per_animal`` compares within an animal only.

    Three levels, since the animal leads the order: ``lag`` inside (month, animal)
    partitions; for an animal's first row the last row of the previous animal of its
    range of ids, from one row per (month, animal); and for the first animal of a range
    the last row of the range before, from one row per (month, range).
    """
    order = ["SurgeryType", "SxComp", "SurgeryTs", "CompDate"]
    d = (df.withColumn("_sday", F.to_date("SurgeryTs"))
         .withColumn("_cus", ntz_micros("CompDate")))
    w_in = Window.partitionBy("reference_date", "AnimalID").orderBy(*order)
    d = d.withColumn("_p_sday", F.lag("_sday").over(w_in)).withColumn("_p_cus", F.lag("_cus").over(w_in))
    if not per_animal:
        last = (d.groupBy("reference_date", "AnimalID")
                .agg(F.max(F.struct(*[F.col(c) for c in order], F.col("_sday").alias("s"), F.col("_cus").alias("c")))
                     .alias("_last")))
        last = last.withColumn("_range", F.floor(F.col("AnimalID") / ANIMAL_RANGE))
        w_r = Window.partitionBy("reference_date", "_range").orderBy("AnimalID")
        ends = (last.groupBy("reference_date", "_range").agg(F.max_by("_last", "AnimalID").alias("_end"))
                .withColumn("_end", F.lag("_end").over(Window.partitionBy("reference_date").orderBy("_range"))))
        prev = (last.withColumn("_lag", F.lag("_last").over(w_r)).join(ends, ["reference_date", "_range"], "inner")
                .select("reference_date", "AnimalID", F.coalesce("_lag", "_end").alias("_prev")))
        d = (join_large(d, prev, ["reference_date", "AnimalID"], "left")
             .withColumn("_first_of_animal", F.col("_p_sday").isNull() & F.col("_p_cus").isNull())
             .withColumn("_p_sday", F.when(F.col("_first_of_animal"), F.col("_prev.s")).otherwise(F.col("_p_sday")))
             .withColumn("_p_cus", F.when(F.col("_first_of_animal"), F.col("_prev.c")).otherwise(F.col("_p_cus"))))
    s_gap = F.coalesce(F.datediff("_sday", "_p_sday") > SURGERY_GAP_DAYS, F.lit(False))
    c_gap = F.coalesce((F.col("_cus") - F.col("_p_cus")) > COMPLICATION_GAP_HOURS * 3600 * 1000000, F.lit(False))
    keep = s_gap | c_gap
    if per_animal:
        keep = keep | F.col("_p_sday").isNull()
    return d.where(keep).select(*df.columns)


MERGE_COLS = ["AnimalID", "Name", "Species", "Sex", "SurgeryType", "SurgeryCategory", "SurgeryDate",
              "SurgeryCategory_refined", "SurgeonName"]


def merge_complications(numerator: DataFrame, denominator: DataFrame) -> DataFrame:
    """Comp / NoComp rows, one per (animal, surgery month, category), Comp wins.

    Remaining ties are broken by surgery date, type, refined category, surgeon.
    """
    # under a name of its own on both sides, so that the union of rows dealt by animal is known to be dealt by it
    numerator, denominator = (df.select(F.col("AnimalID").alias("_animal"), *MERGE_COLS[1:]) for df in (numerator, denominator))
    rows = (numerator.withColumn("Type", F.lit("Comp"))
            .unionByName(denominator.withColumn("Type", F.lit("NoComp"))))
    rows = rows.withColumn("SurgeryMonth", month_start("SurgeryDate"))
    first = keep_first(rows, ["_animal", "SurgeryMonth", "SurgeryCategory"],
                       [Ord("Type"), Ord("SurgeryDate"), Ord("SurgeryType"), Ord("SurgeryCategory_refined"),
                        Ord("SurgeonName"), Ord("Name"), Ord("Species"), Ord("Sex")])
    return first.withColumnRenamed("_animal", "AnimalID")


def type_share(df: DataFrame, category_col: str, as_of: _dt.date, date_col: str = "SurgeryDate",
               categories: Sequence[str] = ("Spay", "Neuter")) -> DataFrame:
    """C10 after P11: percent of each Type per (species group, category, month) on the
    full grid of observed values, missing cells 0, one decimal."""
    recent = trailing_months(df, as_timestamp(date_col), as_of, 13)
    d = (recent.where(F.col(category_col).isin(list(categories)))
         .select(F.when(F.col("Species") == "Special Species", F.lit("special")).otherwise(F.lit("cat_dog"))
                 .alias("SpeciesGroup"), category_col, month_start(date_col).alias("SurgeryMonth"), "Type"))
    dims = ["SpeciesGroup", category_col, "SurgeryMonth"]
    counts = d.groupBy(*dims, "Type").agg(F.count(F.lit(1)).alias("_n"))
    # counts hold one row per grid cell (a few hundred at most): window total
    total = F.sum("_n").over(Window.partitionBy(*dims))
    share = counts.select(*dims, "Type", (F.col("_n") / total * 100).alias("Percentage"))
    grid = observed_grid(d, dims + ["Type"])
    return (grid.join(share, dims + ["Type"], "left")
            .select(*dims, "Type", F.round(F.coalesce("Percentage", F.lit(0.0)), 1).alias("Percentage")))


def _both(m: Model, spine: MonthSpine, cfg: SurgeryConfig, site_groups: Sequence,
          location: bool = True) -> tuple[DataFrame, DataFrame]:
    """Surgeries and complications from treatment rows that are written once."""
    meds = tuple(dict.fromkeys(cfg.den_medications + cfg.num_medications))
    rows = treatment_rows(m, spine, meds, location, stored=True)
    return (surgeries(m, spine, cfg, site_groups, rows, ranked=False),
            surgical_complications(m, spine, cfg, site_groups, rows, ranked=False))


def surgery_report(m: Model, spine: MonthSpine, as_of: _dt.date, cfg: SurgeryConfig = GENERAL,
                   site_groups: Sequence = ()) -> dict[str, DataFrame]:
    den, num = (materialize(df) for df in _both(m, spine, cfg, site_groups))
    merged = merge_complications(num, den)
    return {"denominator": den, "numerator": num, "merged": merged,
            "share": type_share(merged, "SurgeryCategory_refined", as_of)}


def merged_report(m: Model, spine: MonthSpine, cfg: SurgeryConfig = GENERAL, site_groups: Sequence = ()) -> DataFrame:
    """The merged table alone."""
    den, num = _both(m, spine, cfg, site_groups, location=False)
    return merge_complications(num, den)


def type_share_report(m: Model, spine: MonthSpine, as_of: _dt.date, cfg: SurgeryConfig = GENERAL,
                      site_groups: Sequence = ()) -> DataFrame:
    """The share table alone: the surgeries of the trailing months of P11 only.

    Surgeries and complications pair within a month, so no other month can matter.
    """
    merged = merged_report(m, spine.trailing(as_of) or spine, cfg, site_groups)
    return type_share(materialize(merged), "SurgeryCategory_refined", as_of)
