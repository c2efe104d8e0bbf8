"""Report sinks (S6, S7, S8): tables instead of workbook sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", sort_by: list[str] | None = None) -> None:
    """One relation to one dataset (parquet by default, CSV with header).

    ``sort_by`` (O1) orders the output only here, at the sink: a range-partitioned
    sort, so files are ordered and each holds a contiguous key range.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # RFC 4180 quoting (doubled quotes), the form the export reader expects
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_numerator_denominator(numerator: DataFrame, denominator: DataFrame, root: str,
                                fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """The two report relations as ``root/Numerator`` and ``root/Denominator``."""
    write_table(denominator, f"{root}/Denominator", fmt, partition_by)
    write_table(numerator, f"{root}/Numerator", fmt, partition_by)


def write_by_month_label(df: DataFrame, date_col: str, root: str, fmt: str = "parquet") -> None:
    """One output folder per report month, labelled like ``2024-Jan`` (``report_month=2024-Jan``).

    A run replaces the folders of the months it holds and leaves all others as they are.
    """
    labelled = df.withColumn("report_month", F.date_format(F.col(date_col), "yyyy-MMM"))
    labelled.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").options(
        **({"header": True, "escape": '"'} if fmt == "csv" else {})).partitionBy("report_month").save(root)
