"""Publishing of report relations (S6, S7, S8): staged month folders and a manifest that names the valid ones.

``publish`` writes each relation's months into folders of their own run and, when all of them are
complete, a new manifest version with one row per (relation, month): the digest of the month's rows
and the folder that holds them. Readers (``read_published``) follow the newest complete manifest, so

* a run replaces only months whose rows differ from the published ones,
* months that a run does not cover stay,
* a run that fails at any point leaves the published report as it was; its folders are never read, and
  running it again publishes it.

One run publishes a report at a time. Folders of failed and replaced runs stay until the report's owner removes them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.operators.spine import MonthSpine
from shelterlens.session import materialize

WHOLE = "all"      # the month label of relations that are one table for all months
MANIFEST = "relation string, report_month string, digest string, n_rows long, folder string, columns string"


@dataclass(frozen=True)
class Relation:
    """A report relation: its rows, the date column of its months (none: one table) and the order inside a file (O1)."""
    name: str
    rows: DataFrame
    month: str | None = None
    sort_by: tuple[str, ...] = ()


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _newest(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and folder of the newest complete manifest (0: none)."""
    fs, where = _path(spark, f"{root}/_manifest/v=*/_SUCCESS")
    found = fs.globStatus(where) or []
    versions = sorted((int(s.getPath().getParent().getName()[2:]), s.getPath().getParent().toString()) for s in found)
    return versions[-1] if versions else (0, None)


def manifest(spark: SparkSession, root: str) -> list:
    """Rows of the newest complete manifest (a row per relation and month)."""
    _, folder = _newest(spark, root)
    return spark.read.schema(MANIFEST).json(folder).collect() if folder else []


def _label(date_col: str):
    return F.date_format(F.col(date_col), "yyyy-MMM")


def covered_labels(spine: MonthSpine | Sequence[_dt.date]) -> set[str]:
    """Labels of the months that a run covers."""
    return {d.strftime("%Y-%b") for d in (spine.months if isinstance(spine, MonthSpine) else spine)}


def publish(spark: SparkSession, root: str, relations: Sequence[Relation], covered: set[str] | None = None,
            fmt: str = "parquet") -> dict[str, list[str]]:
    """Publishes the relations of one report under ``root``; the months written, by relation.

    ``covered``: labels of the run's months; published months outside it stay. None: the run covers all.
    """
    old = {(r.relation, r.report_month): r for r in manifest(spark, root)}
    run, rows, written = uuid.uuid4().hex, [], {}
    for rel in relations:
        label = F.lit(WHOLE) if rel.month is None else F.coalesce(_label(rel.month), F.lit("undated"))
        df = materialize(rel.rows.withColumn("report_month", label))
        columns = rel.rows.schema.json()
        values = F.xxhash64(*[F.col(f"`{c}`") for c in rel.rows.columns])
        other = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in rel.rows.columns])
        digests = df.groupBy("report_month").agg(
            F.count("*").alias("n"), F.sum(values.cast("decimal(38,0)")).alias("a"),
            F.sum(other.cast("decimal(38,0)")).alias("b")).collect()      # one row per month
        if rel.month is None and not digests:
            digests = [{"report_month": WHOLE, "n": 0, "a": 0, "b": 0}]   # an empty table is a result too
        new = {d["report_month"]: (f"{d['n']}-{d['a']}-{d['b']}", d["n"]) for d in digests}
        changed = [m for m, (digest, _) in new.items()
                   if (rel.name, m) not in old or (old[rel.name, m].digest, old[rel.name, m].columns) != (digest, columns)]
        folder = f"{root}/{rel.name}/run={run}"
        if changed:
            out = df.where(F.col("report_month").isin(changed))
            out = out.orderBy("report_month", *rel.sort_by) if rel.sort_by else out.repartition("report_month")
            writer = out.write.format(fmt).partitionBy("report_month")
            (writer.option("header", True).option("escape", '"') if fmt == "csv" else writer).save(folder)
        for m, (digest, n) in new.items():
            at = folder if m in changed else old[rel.name, m].folder
            rows.append((rel.name, m, digest, n, at, columns))
        for (name, m), r in old.items():
            if name == rel.name and m not in new and covered is not None and m not in covered and m != WHOLE:
                rows.append(tuple(r))
        written[rel.name] = sorted(changed)
    named = {rel.name for rel in relations}
    rows += [tuple(r) for r in old.values() if r.relation not in named]
    number, _ = _newest(spark, root)
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{root}/_manifest/v={number + 1}")
    return written


def read_published(spark: SparkSession, root: str, relation: str, fmt: str = "parquet") -> DataFrame:
    """The published rows of a relation, with their ``report_month``."""
    from pyspark.sql.types import StructType
    import json

    held = [r for r in manifest(spark, root) if r.relation == relation]
    if not held:
        raise ValueError(f"{root}: no published relation {relation}")
    schema = StructType.fromJson(json.loads(held[0].columns))
    out = spark.createDataFrame([], schema).withColumn("report_month", F.lit(None).cast("string"))
    by_folder: dict[str, list[str]] = {}
    for r in held:
        if r.n_rows:
            by_folder.setdefault(r.folder, []).append(r.report_month)
    reader = spark.read.schema(StructType([*schema.fields, *out.select("report_month").schema.fields])).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    for folder, months in sorted(by_folder.items()):
        out = out.unionByName(reader.load(folder).where(F.col("report_month").isin(months)))
    return out
