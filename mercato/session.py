"""Session settings and the shared folder used to cut lineage and stage tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on; all are safe to set on a session that already runs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split also where the next operator then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # rows of long text go to Python a few megabytes at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # sessions of one key are merged map-side before the shuffle
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Settings a session may have made for itself. Shuffled numbers compress well: 64 MB of them, to which Spark would merge
# partitions, fill a gigabyte or two of one task's hash tables.
DEFAULT_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built, and give its executors this package."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a context: tasks in Python need them, wherever they run."""
    context = spark.sparkContext
    if getattr(context, "mercato_shipped", False):
        return
    folder, root = tempfile.mkdtemp(prefix="mercato-code-"), Path(__file__).resolve().parent
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves the file as long as the session lives
    with zipfile.ZipFile(f"{folder}/mercato.zip", "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(f"{folder}/mercato.zip")
    context.mercato_shipped = True


def build_session(app: str = "mercato", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. ``master`` stays unset on a cluster, where spark-submit names it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see.

    It is the session's ``spark.checkpoint.dir``. Only a local session, where driver and executors are one process,
    may fall back to a temporary folder; on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="mercato-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table under the shared folder; no two calls return the same one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, a query deletes its shuffles when it ends; one that reads them again would make them again."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table under the shared folder and read it back, with no lineage and a known size.

    Used where a plan loops, or where a value such as a partition number must never be computed twice. The stored table
    survives lost executors, later reads prune its columns, and the planner sees its true size. What was shuffled for it is
    deleted at once, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    with shuffles_dropped(spark):
        df.write.parquet(path)
    pinned = spark.read.schema(df.schema).parquet(path)
    pinned.pinned_at = path
    return pinned


def unpin(pinned: DataFrame | None) -> None:
    """Delete a pinned table that a later one has replaced. Nothing may still read it; None is nothing to delete."""
    if pinned is not None:
        spark = pinned.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(pinned.pinned_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def append_pinned(df: DataFrame, path: str | None = None, part: int = 0) -> str:
    """Store ``df`` as folder ``part`` of a growing table under the shared folder; returns the table's path."""
    path = path or scratch_path(df.sparkSession, "pinned")
    df.write.mode("overwrite").parquet(f"{path}/{part}")
    return path
