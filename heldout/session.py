"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "heldout", event_log_dir: str | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    AQE re-plans joins and aggregations from measured shuffle sizes: it turns a
    sort-merge join into a broadcast join only when the built side is measured
    small, splits skewed join partitions, and coalesces tiny shuffle
    partitions.  The UI stays off (no server is opened); stage and task times
    can instead go to a Spark event log in ``event_log_dir``.
    """
    builder = SparkSession.builder
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Checkpoint files of DataFrames that are no longer referenced are
        # deleted, so repeated fits do not fill the shared folder.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is.  Only a local-mode session with no folder set (tests, the bench)
    gets a fresh scratch folder of its own.  A cluster session without one is
    an error: a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder.
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="heldout-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    their Python workers can import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_heldout_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="heldout-")) / "heldout_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._heldout_shipped = True


def scratch_path(spark: SparkSession) -> str:
    """A new path for a stored table, in this application's folder below the
    checkpoint folder.  The file system deletes it when the application ends."""
    root = f"{ensure_checkpoint_dir(spark)}/heldout-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{root}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once: one Parquet write below the shared checkpoint
    folder, read back (lineage cut).

    The rows survive the loss of any executor.  Reading back lets later steps
    prune columns and gives AQE a measured size; a plan that ends in a shuffle
    is coalesced by AQE before the write, so a small table is a handful of
    files however many shuffle partitions the session has.  ``release``
    deletes the files early; otherwise they go when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def release(*frames: DataFrame) -> None:
    """Delete the files of tables from ``materialize`` that nothing reads any
    more.  Frames from elsewhere are ignored."""
    for df in frames:
        stored_at = getattr(df, "_stored_at", None)
        if stored_at:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(stored_at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
