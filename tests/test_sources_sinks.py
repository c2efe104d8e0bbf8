"""S2 (CSV exports), S6-S8 (report sinks): round trips through files."""
import tempfile

import pytest
from pyspark.sql import functions as F

from shelterlens.plans import invoices as iv
from shelterlens.plans.roles import exports_from_driver
from shelterlens.sources.sinks import write_by_month_label, write_numerator_denominator, write_table
from shelterlens.sources.tables import read_export_csv

SF = "/root/testdata/sf0.001"


def test_csv_exports_round_trip_into_invoice_report(spark):
    animals, invoices = exports_from_driver(spark, SF)
    root = tempfile.mkdtemp(prefix="shelterlens-csv-")
    write_table(animals.withColumn("Animal Name", F.concat(F.col("Animal Name"), F.lit(", \"quoted\"\nline"))),
                f"{root}/animals", fmt="csv")
    write_table(invoices, f"{root}/invoices", fmt="csv")
    a2 = read_export_csv(spark, f"{root}/animals", iv.ANIMAL_COLUMNS)
    i2 = read_export_csv(spark, f"{root}/invoices", iv.INVOICE_COLUMNS)
    assert a2.count() == animals.count()
    assert a2.where(F.col("`Animal Name`").contains("\n")).count() == animals.count()  # multi-line fields survive
    direct = sorted(map(tuple, iv.invoice_complications(animals, invoices).collect()))
    via_csv = sorted(map(tuple, iv.invoice_complications(a2, i2).collect()))
    assert direct == via_csv and len(direct) > 0


def test_numerator_denominator_and_month_label_sinks(spark):
    root = tempfile.mkdtemp(prefix="shelterlens-out-")
    df = spark.createDataFrame([(1, "2024-01-15"), (2, "2024-02-03")], "id int, d string").withColumn(
        "d", F.to_date("d"))
    write_numerator_denominator(df.where("id = 1"), df, root)
    assert spark.read.parquet(f"{root}/Denominator").count() == 2
    assert spark.read.parquet(f"{root}/Numerator").count() == 1
    write_by_month_label(df, "d", f"{root}/monthly")
    got = {r.report_month for r in spark.read.parquet(f"{root}/monthly").collect()}
    assert got == {"2024-Jan", "2024-Feb"}


def test_month_sink_keeps_other_months_and_years(spark):
    root = tempfile.mkdtemp(prefix="shelterlens-months-")

    def run(*rows):
        write_by_month_label(spark.createDataFrame(list(rows), "id int, d string").withColumn("d", F.to_date("d")),
                             "d", root)

    run((1, "2023-01-15"))
    run((2, "2024-01-15"), (3, "2024-01-20"))
    run((4, "2024-02-01"))
    run((5, "2024-01-31"))   # a second run of a month replaces that month only
    assert {(r.report_month, r.id) for r in spark.read.parquet(root).collect()} == {
        ("2023-Jan", 1), ("2024-Jan", 5), ("2024-Feb", 4)}


def test_csv_columns_are_taken_by_name(spark):
    root = tempfile.mkdtemp(prefix="shelterlens-names-")
    cols = ["Extra", "Species", *[c for c in iv.ANIMAL_COLUMNS if c != "Species"]]
    row = ["x", "Cat", *[f"v-{c}" for c in cols[2:]]]
    spark.createDataFrame([tuple(row)], cols).write.option("header", True).csv(f"{root}/a")
    got = read_export_csv(spark, f"{root}/a", iv.ANIMAL_COLUMNS).first().asDict()
    assert got["Species"] == "Cat" and got["Animal Code"] == "v-Animal Code" and "Extra" not in got
    with pytest.raises(ValueError, match="no column"):
        read_export_csv(spark, f"{root}/a", ["Animal Code", "Absent"])


def test_invoice_dates_take_several_patterns_and_refuse_others(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("1/5/2024",), ("2024-01-05",), (None,)], "t string")
    got = [r[0] for r in df.select(iv.parsed_date("t").cast("date").cast("string")).collect()]
    assert got == ["2024-01-05"] * 3 + [None]
    with pytest.raises(Exception, match="no known date format"):
        spark.createDataFrame([("soon",)], "t string").select(iv.parsed_date("t")).collect()
