"""Session helpers.

Cluster jobs get their session from the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every report relies on: fixed zone-less time arithmetic, AQE for
# runtime coalescing / skew-join splitting, and a broadcast limit that the
# planner checks against measured sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


LOCAL_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.files.maxPartitionBytes": "4m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelterlens") -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # Small local inputs: keep AQE from coalescing every shuffle into one task,
        # since several operators multiply rows after a shuffle (bounded month
        # explodes). Cluster sessions keep their own (64-128 MB) partition targets.
        for key, value in LOCAL_CONF.items():
            builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("SHELTERLENS_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_CKPT: dict[str, str] = {}   # by application id
STORED_AS = "zstd"           # stored intermediates take about a third less than with the session's default


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set.

    Only a local session (one machine) without the setting gets a private scratch
    folder; on a cluster the executors could not see it, so the setting is required.
    """
    app, configured = spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if _CKPT.get(app) != configured:
            spark.sparkContext.setCheckpointDir(configured)
            _CKPT[app] = configured
        return configured
    if app in _CKPT:
        return _CKPT[app]
    if not is_local_master(spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="shelterlens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    _CKPT[app] = local
    return local


def is_local_master(master: str) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession) -> str:
    """A new path under the shared ``spark.checkpoint.dir``; deleted with the application's tables when it ends."""
    import uuid
    root = f"{checkpoint_dir(spark).rstrip('/')}/shelterlens-tables-{spark.sparkContext.applicationId}"
    if root not in _CLEANED:
        _CLEANED.add(root)
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(root)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return f"{root}/{uuid.uuid4().hex}"


def materialize(df):
    """Cut lineage of an intermediate a report reads several times.

    The rows are written once as a parquet table under the shared
    ``spark.checkpoint.dir`` (never a local checkpoint or a machine-local folder
    on a cluster) and read back: later stages scan the table - with column
    pruning and filter pushdown - instead of re-planning and recomputing the
    subtree, and a lost executor does not force recomputation from the sources.
    This runs the subtree at once. The application's tables are deleted when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.mode("overwrite").option("compression", STORED_AS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # no job to infer it, and none needed for no rows


def materialize_dealt(df, by, tasks: int):
    """``materialize`` of rows that are dealt by the hash of ``by`` over ``tasks`` tasks (``operators.joins.deal``).

    They are stored in as many buckets, so whoever reads them finds them dealt and shuffles nothing. The table
    is an entry of the session's catalog, its folder is one of ``scratch_path``.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    table = f"shelterlens_{path.rsplit('/', 1)[-1]}"
    (df.write.format("parquet").option("path", path).option("compression", STORED_AS)
     .bucketBy(tasks, *by).sortBy(*by).saveAsTable(table))
    return spark.read.table(table)


_CLEANED: set[str] = set()
