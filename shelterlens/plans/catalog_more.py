"""Further registered queries (imported by ``catalog._load_all``)."""

from pyspark.sql import DataFrame, SparkSession

from shelterlens.plans import surgery as sx
from shelterlens.plans.catalog import register
from shelterlens.plans.oracle_surgery import surgery_sql
from shelterlens.plans.params import AS_OF, SPINE
from shelterlens.plans.roles import model_from_driver
from shelterlens.session import materialize, scratch_path

# Site groups of the benchmark run (sites are supplier nations in the role mapping).
SITE_GROUPS = ((("NATION_0", "NATION_1"), "Shelter"), (("NATION_2", "NATION_3", "NATION_4"), "Public clinic"))


# ---------------------------------------------------------------- surgery
@register("surgery_dedup", surgery_sql(sx.GENERAL, SITE_GROUPS, "den"))
def surgery_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.surgeries(model_from_driver(spark, sf_dir), SPINE, sx.GENERAL, SITE_GROUPS)


@register("complication_min_days", surgery_sql(sx.GENERAL, SITE_GROUPS, "num"))
def complication_min_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.surgical_complications(model_from_driver(spark, sf_dir), SPINE, sx.GENERAL, SITE_GROUPS)


@register("merge_complications", surgery_sql(sx.GENERAL, SITE_GROUPS, "merged"))
def merge_complications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.merged_report(model_from_driver(spark, sf_dir), SPINE, sx.GENERAL, SITE_GROUPS)


@register("type_share_grid", surgery_sql(sx.GENERAL, SITE_GROUPS, "share"))
def type_share_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.type_share_report(model_from_driver(spark, sf_dir), SPINE, AS_OF, sx.GENERAL, SITE_GROUPS)


@register("dental_surgeries", surgery_sql(sx.DENTAL, SITE_GROUPS, "den"))
def dental_surgeries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.surgeries(model_from_driver(spark, sf_dir), SPINE, sx.DENTAL, SITE_GROUPS)


@register("dental_complications", surgery_sql(sx.DENTAL, SITE_GROUPS, "num"))
def dental_complications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.surgical_complications(model_from_driver(spark, sf_dir), SPINE, sx.DENTAL, SITE_GROUPS)


# ---------------------------------------------------------------- wait time (C13, C14), delayed
from shelterlens.plans import delayed as dl  # noqa: E402
from shelterlens.plans import wait as wt  # noqa: E402
from shelterlens.plans.oracle_more import delayed_sql, wait_sql  # noqa: E402
from shelterlens.plans.params import WAIT_HISTORY_START  # noqa: E402


@register("wait_by_category", wait_sql("wait"))
def wait_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wt.surgery_wait(model_from_driver(spark, sf_dir), SPINE, spark, WAIT_HISTORY_START)


@register("wait_buckets", wait_sql("buckets"))
def wait_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    wait = materialize(wt.surgery_wait(model_from_driver(spark, sf_dir), SPINE, spark, WAIT_HISTORY_START))
    return wt.wait_buckets(wait, AS_OF)


@register("delayed_outcome", delayed_sql())
def delayed_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.delayed_outcome(model_from_driver(spark, sf_dir), SPINE)


@register("wait_current_year", wait_sql("current_year"))
def wait_current_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wt.wait_subsets(wait_buckets(spark, sf_dir), AS_OF)["current_year"]


@register("wait_trailing", wait_sql("trailing"))
def wait_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wt.wait_subsets(wait_buckets(spark, sf_dir), AS_OF)["trailing"]


@register("dental_merge", surgery_sql(sx.DENTAL, SITE_GROUPS, "merged"))
def dental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.merged_report(model_from_driver(spark, sf_dir), SPINE, sx.DENTAL, SITE_GROUPS)


# ---------------------------------------------------------------- kitten mortality
from shelterlens.plans import kitten as kt  # noqa: E402
from shelterlens.plans.oracle_more import kitten_sql  # noqa: E402
from shelterlens.plans.params import KITTEN_AS_OF, KITTEN_SPINE, KITTEN_START  # noqa: E402


@register("weekly_presence_cohort", kitten_sql("cohort", KITTEN_START, AS_OF))
def weekly_presence_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kt.kitten_cohort(model_from_driver(spark, sf_dir), SPINE, AS_OF, KITTEN_START)


@register("mortality_percent", kitten_sql("percent", KITTEN_START, KITTEN_AS_OF, KITTEN_SPINE))
def mortality_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = materialize(kt.kitten_cohort(model_from_driver(spark, sf_dir), KITTEN_SPINE, KITTEN_AS_OF, KITTEN_START))
    return kt.mortality_percent(kt.fill_kitten_grid(cohort), KITTEN_AS_OF)


# ---------------------------------------------------------------- length of stay
from shelterlens.plans import stay as sy  # noqa: E402
from shelterlens.plans.oracle_more import stay_sql  # noqa: E402


@register("stay_with_dwell", stay_sql("outcomed"))
def stay_with_dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.los_outcomed(model_from_driver(spark, sf_dir, line_locations=True), SPINE)


@register("open_stay_with_dwell", stay_sql("open"))
def open_stay_with_dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.los_not_outcomed(model_from_driver(spark, sf_dir, line_locations=True), SPINE)


# ---------------------------------------------------------------- clinic invoices
from shelterlens.plans import invoices as iv  # noqa: E402
from shelterlens.plans.oracle_more import invoice_sql  # noqa: E402
from shelterlens.plans.roles import exports_from_driver  # noqa: E402


@register("invoice_complications", invoice_sql("rows", AS_OF))
def invoice_complications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.invoice_complications(*exports_from_driver(spark, sf_dir))


@register("invoice_type_share", invoice_sql("share", AS_OF))
def invoice_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.invoice_share(materialize(iv.invoice_complications(*exports_from_driver(spark, sf_dir))), AS_OF)


@register("invoice_numerator", invoice_sql("numerator", AS_OF))
def invoice_numerator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iv.report_numerator(iv.invoice_complications(*exports_from_driver(spark, sf_dir)))


@register("surgery_rank", surgery_sql(sx.GENERAL, SITE_GROUPS, "rank"))
def surgery_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sx.surgery_rank(model_from_driver(spark, sf_dir), SPINE)


@register("kitten_numerator", kitten_sql("numerator", KITTEN_START, AS_OF))
def kitten_numerator(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohort = materialize(kt.kitten_cohort(model_from_driver(spark, sf_dir), SPINE, AS_OF, KITTEN_START))
    return kt.kitten_numerator(kt.fill_kitten_grid(cohort))


# ---------------------------------------------------------------- exports as files, sorted output, containment
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelterlens.operators.timeline import cover_counts  # noqa: E402
from shelterlens.plans import run  # noqa: E402
from shelterlens.plans.roles import with_roles  # noqa: E402
from shelterlens.sources.sinks import write_table  # noqa: E402


@register("invoice_from_csv", invoice_sql("rows", AS_OF))
def invoice_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice rows of exports that went through CSV files in the shared folder."""
    folder = scratch_path(spark)
    for name, df in zip(("animals", "invoices"), exports_from_driver(spark, sf_dir)):
        write_table(df, f"{folder}/{name}", fmt="csv")
    return run.invoices_from_csv(spark, f"{folder}/animals", f"{folder}/invoices")


DELAYED_ORDER = ("ReportDate", "AnimalID", "IntakeDate")


@register("sorted_delayed_list", f"""
SELECT *, row_number() OVER (ORDER BY {', '.join(DELAYED_ORDER)}) AS place FROM ({delayed_sql()})""")
def sorted_delayed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 with S7: the delayed list written in order; ``place`` is where a row lies in the files."""
    path = f"{scratch_path(spark)}/Delayed"
    write_table(delayed_outcome(spark, sf_dir), path, sort_by=list(DELAYED_ORDER))
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"),
                                             F.col("_metadata.row_index").alias("_at"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)     # one row per file
    files = stored.groupBy("_file").count().select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return (stored.join(files, "_file").withColumn("place", F.col("_before") + F.col("_at") + 1)
            .drop("_file", "_at", "_before"))


@register("stay_location_cover", with_roles("""
SELECT l.AnimalID, l.Location, l.LastUpdated,
       (SELECT count(*) FROM visits_out v WHERE v.AnimalID = l.AnimalID AND v.tin_DateCreated < l.LastUpdated
          AND l.LastUpdated < v.tOut_DateCreated) AS n_stays
FROM line_locations l"""))
def stay_location_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of stays that hold each location row, by a sweep line over all stays."""
    m = model_from_driver(spark, sf_dir, line_locations=True)
    return cover_counts(m["locations"], m["visits_out"], ["AnimalID"], "LastUpdated", "tin_DateCreated",
                        "tOut_DateCreated", "n_stays").select("AnimalID", "Location", "LastUpdated", "n_stays")
