"""Session construction and shared-folder helpers.

Nothing here holds global state: every operator takes DataFrames in and gives
DataFrames out.  The helpers only read settings from the active session.
"""

from __future__ import annotations

import contextlib
import urllib.parse
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "lexiflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings this library is tuned for.

    The master is set only where it is given; otherwise spark-submit or the
    cluster's own settings decide.  AQE stays on, so that joins pick broadcast or
    sort-merge by run-time bytes and skewed join partitions are split.
    Checkpoints whose table is no longer referenced are deleted by Spark.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_machine(master: str) -> bool:
    """Whether driver and tasks are one process, so that a local folder is shared."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Where that is
    unset, a folder inside the warehouse; on a cluster whose warehouse is a
    machine's own folder the setting is asked for.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if not one_machine(sc.master) and urllib.parse.urlsplit(configured).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, fixes the partitioning."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


# Whether Spark deletes a job's shuffle files when the job has ended.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For jobs whose result is written: what they shuffled goes when they have ended,
    else it would stay on the executors' disks until the driver collects its garbage."""
    old = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if old is None else spark.conf.set(CLEAN_SHUFFLES, old)


def stored(df: DataFrame, name: str, at: str | None = None, **options: int) -> DataFrame:
    """``df`` written to the shared folder (to ``at`` if given) and read back: a lookup
    table whose bytes the planner knows, so it picks the join's form before the large
    side is shuffled; and a lost executor does not compute it again.  What it was made
    of is no longer shuffled then."""
    path = at or scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A new path under the shared folder, removed when the block ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table or folder that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
