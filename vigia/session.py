"""SparkSession construction and shared-folder resolution.

The settings here are the ones every job in the package relies on:

* AQE on, with partition coalescing and skew-join splitting, so a municipality
  holding a third of all notifications does not become one giant reduce task.
* Session time zone pinned to UTC: the notification dates are calendar dates
  and must not shift with the driver's locale.
* ANSI mode left on (Spark 4 default); every lenient parse uses ``try_*``.
* No web UI.

On a cluster the session is created by the platform; ``get_spark`` then only
returns the active session.  ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the session and only invents a local folder when it is unset (tests).
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target ~256 MB per task after AQE coalescing, and per file split.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dimension tables (states, municipalities, symptom names) are joined by
    # broadcast only when the planner's measured size is under this bound;
    # above it the join falls back to a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vigia", extra_conf: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with the package defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    # spark.checkpoint.dir is not set here: it comes from the cluster / the
    # Spark defaults and is read back by checkpoint_dir() after the build.
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local-mode session
    without one gets a fresh local scratch folder; on a cluster a missing
    shared folder is an error, never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            path = None
    if not path:
        path = _LOCAL_FALLBACK.get(id(sc))
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all "
                               "executors (checkpoints and intermediate tables go there)")
        path = tempfile.mkdtemp(prefix="vigia-ckpt-", dir=os.environ.get("VIGIA_SCRATCH", "/tmp"))
        _LOCAL_FALLBACK[id(sc)] = path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_LOCAL_FALLBACK: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    import uuid
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


#: Bytecodes of a method up to which HotSpot compiles it.
COMPILED_METHOD = "8000"
#: Shuffle files go with the job that wrote them; tables are packed tighter.
LITTLE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
               "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """The session with these settings inside the block, as it was behind it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def compiled_methods(spark: SparkSession):
    """For jobs over rows of many columns: one generated method for all columns
    of such a row is longer than HotSpot compiles and stays interpreted.  Inside
    the block Spark evaluates these rows by operators of short methods."""
    return _settings(spark, {"spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD})


def little_disk(spark: SparkSession):
    """For a chain of jobs that each write a table as large as the input: Spark
    keeps the shuffle files of a finished job until the driver happens to
    collect its objects.  Inside the block they are removed when the job has
    ended (no later job reads them: the table is read instead)."""
    return _settings(spark, LITTLE_DISK)


def reliable_checkpoint(df, name: str = "stage"):
    """Cut the lineage of ``df`` with a table written to the shared checkpoint
    folder, read back with the same schema (never localCheckpoint).

    One job computes ``df`` once and writes it as Parquet (an RDD checkpoint
    of an unpersisted frame would compute it twice: once for the eager count,
    once for the checkpoint write).  The copy survives executor loss, and
    values computed from the physical layout (provisional row ids, partition
    numbers) are stored as data, so later jobs see exactly the same values."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
