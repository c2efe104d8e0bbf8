"""Month-partitioned, animal-bucketed copy of the shelter model.

``store_model`` writes every frame of a resolved model below a shared root: event frames in one folder per
month of their time column, each month hashed by animal into the same number of buckets. Reports that
read the copy (``open_model``) join and group by animal without a shuffle, and a report's time bounds
(``bounded``) become partition filters, so the other months are not even listed.

* Hot animals: rows are dealt over tasks by (month, bucket) and a task that gets too much is split, so the
  write holds no animal together. In a bucketed scan one task reads a whole bucket; a frame whose
  largest bucket is over ``HOT_BUCKET`` times the mean is therefore opened as plain month folders:
  its joins shuffle as without the copy, and adaptive execution splits the hot key.
* ``replace_months`` writes the months of a frame that a load changed. The frame's new rows go to a version
  folder of their own and the copy's manifest names the folder of each frame, so a reader
  sees the old or the new version, and a write that fails changes nothing. Old versions stay
  until their owner removes them.
* Rows whose time is null are kept in a folder of their own, which no time bound reads.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelterlens.functions.dates import as_timestamp
from shelterlens.sources.model import Model

MONTH = "stored_month"      # first day of the row's month; only stored frames have it
HOT_BUCKET = 4.0
MANIFEST = "frame string, version long, folder string, columns string, n_buckets int, hot boolean"


@dataclass(frozen=True)
class Layout:
    """Key that buckets a frame and the time column of its months (None: not split by month)."""
    key: str
    time: str | None = None


LAYOUTS = {
    "animals": Layout("AnimalID"),
    "visits": Layout("AnimalID", "tin_DateCreated"),
    "visits_out": Layout("AnimalID", "tin_DateCreated"),
    "intake_status": Layout("OperationRecordID", "StatusDateTime"),
    "exam_conditions": Layout("AnimalID", "DateCreated"),
    "statuses": Layout("AnimalID", "LastUpdated"),
    "locations": Layout("AnimalID", "LastUpdated"),
    "euthanasia": Layout("AnimalID", "DateCreated"),
    "treatments": Layout("AnimalID", "StatusDateTime"),
}


def bounded(df: DataFrame, column: str, since: _dt.date | None = None, before: _dt.date | None = None) -> DataFrame:
    """Rows with ``since <= column < before`` (days, 00:00); a stored frame reads only the months in between."""
    tests: list[Column] = []
    if since is not None:
        tests.append(F.col(column) >= as_timestamp(F.lit(since)))
    if before is not None:
        tests.append(F.col(column) < as_timestamp(F.lit(before)))
    if MONTH in df.columns and df.select(MONTH).schema[0].metadata.get("of") == column:
        if since is not None:
            tests.append(F.col(MONTH) >= F.lit(since.replace(day=1)))
        if before is not None:
            tests.append(F.col(MONTH) < F.lit(before))
    for test in tests:
        df = df.where(test)
    return df


def store_model(model: Model, root: str, n_buckets: int, frames: tuple[str, ...] = tuple(LAYOUTS)) -> None:
    """Write ``frames`` of the model below ``root``; a version becomes visible when all of them are written.

    ``n_buckets``: choose it so that a bucket of the months that a report reads fits a task (as
    ``spark.sql.shuffle.partitions`` is chosen); all frames share it, or their joins would shuffle.
    """
    _publish(root, [_write(model[name], name, root, n_buckets) for name in frames])


def replace_months(spark: SparkSession, root: str, name: str, rows: DataFrame, since: _dt.date,
                   before: _dt.date | None = None) -> None:
    """Replace the months [``since``, ``before``) of one stored event frame by the rows of these months in ``rows``."""
    layout = LAYOUTS[name]
    if layout.time is None or since.day != 1 or (before is not None and before.day != 1):
        raise ValueError("whole months of a frame with a time column can be replaced")
    held = {r.frame: r for r in _current(spark, root)}[name]
    old = _plain(spark, held)
    outside = F.col(MONTH).isNull() | (F.col(MONTH) < F.lit(since))
    if before is not None:
        outside = outside | (F.col(MONTH) >= F.lit(before))
    kept = old.where(outside).drop(MONTH)
    fresh = bounded(rows.select(*kept.columns), layout.time, since, before)
    _publish(root, [_write(kept.unionByName(fresh), name, root, held.n_buckets)])


def open_model(spark: SparkSession, root: str) -> Model:
    """The stored model. Its frames have the column ``stored_month`` besides (events only).

    Bucketed tables are entries of the session's catalog, named after their folder.
    """
    out = {}
    for r in _current(spark, root):
        out[r.frame] = _plain(spark, r) if r.hot else _bucketed(spark, r)
    return out


@contextlib.contextmanager
def co_partitioned(spark: SparkSession):
    """Runs joins on (animal, more keys) in the buckets of the animal alone while the block runs.

    Spark shuffles both sides of such a join on all its keys unless told that the buckets will do. The
    setting is read when a query is planned, so the action belongs into the block; the session's
    own value comes back afterwards. Frames with hot buckets are not read as buckets, so they are
    not affected unless they meet a bucketed frame in a join on several keys.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---------------------------------------------------------------- files
def _write(df: DataFrame, name: str, root: str, n_buckets: int) -> tuple:
    spark, layout = df.sparkSession, LAYOUTS[name]
    if MONTH in df.columns:
        df = df.drop(MONTH)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    folder = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    bucket = F.pmod(F.hash(layout.key), F.lit(n_buckets))       # as bucketBy deals rows
    keys = ["_bucket"]
    if layout.time is not None:
        df = df.withColumn(MONTH, F.trunc(F.col(layout.time).cast("date"), "month"))
        keys.insert(0, MONTH)
    # one task a cell of (month, bucket), cells of one task side by side; oversized tasks are split
    dealt = df.withColumn("_bucket", bucket).hint("rebalance", *keys).drop("_bucket")
    writer = dealt.write.format("parquet").option("path", folder)
    if layout.time is not None:
        writer = writer.partitionBy(MONTH)
    table = _table(folder)
    writer.bucketBy(n_buckets, layout.key).sortBy(layout.key).saveAsTable(table)
    n, largest = (spark.read.table(table).groupBy(bucket.alias("b")).count()
                  .agg(F.sum("count"), F.max("count")).first())
    hot = bool(n) and largest > HOT_BUCKET * max(1.0, n / n_buckets)
    return spark, (name, folder, columns, n_buckets, hot)


def _publish(root: str, written: list[tuple]) -> None:
    """A new manifest version: the frames written now, and the others as they were."""
    spark = written[0][0]
    try:
        held = _current(spark, root)
    except FileNotFoundError:
        held = []
    version = 1 + max((r.version for r in held), default=0)
    now = {row[0]: row for _, row in written}
    rows = [(n, version, *rest) for n, *rest in now.values()]
    rows += [(r.frame, version, r.folder, r.columns, r.n_buckets, r.hot) for r in held if r.frame not in now]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{root.rstrip('/')}/_manifest/{version:08d}")


def _current(spark: SparkSession, root: str) -> list:
    """Rows of the newest complete manifest (one per frame)."""
    jvm, path = spark.sparkContext._jvm, f"{root.rstrip('/')}/_manifest"
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [str(s.getPath().toString()) for s in fs.listStatus(where)] if fs.exists(where) else []
    done = [f for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{f}/_SUCCESS"))]
    if not done:
        raise FileNotFoundError(f"no stored model under {root}")
    return spark.read.schema(MANIFEST).parquet(max(done)).collect()


def _plain(spark: SparkSession, r) -> DataFrame:
    layout = LAYOUTS[r.frame]
    columns = r.columns + (f", {MONTH} date" if layout.time else "")
    return _tagged(spark.read.schema(columns).parquet(r.folder), layout)


def _bucketed(spark: SparkSession, r) -> DataFrame:
    layout, table = LAYOUTS[r.frame], _table(r.folder)
    if not spark.catalog.tableExists(table):
        month = (f", {MONTH} date", f"PARTITIONED BY ({MONTH})") if layout.time else ("", "")
        spark.sql(f"CREATE TABLE {table} ({r.columns}{month[0]}) USING parquet {month[1]} "
                  f"CLUSTERED BY ({layout.key}) SORTED BY ({layout.key}) INTO {r.n_buckets} BUCKETS "
                  f"LOCATION '{r.folder}'")
        if layout.time:
            spark.catalog.recoverPartitions(table)
    return _tagged(spark.read.table(table), layout)


def _tagged(df: DataFrame, layout: Layout) -> DataFrame:
    """``stored_month`` says in its metadata which time column it belongs to."""
    if layout.time is None:
        return df
    return df.withColumn(MONTH, F.col(MONTH).alias(MONTH, metadata={"of": layout.time}))


def _table(folder: str) -> str:
    return f"shelterlens_{folder.rsplit('/', 2)[-2]}_{zlib.crc32(folder.encode()):08x}".lower()
