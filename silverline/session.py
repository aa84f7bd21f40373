"""Session defaults and shared-storage helpers.

Nothing here changes query semantics; it only pins the settings the operators
rely on (UTC session zone, ANSI mode on, AQE on) and finds the shared folder
for checkpoints and staged output.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows sent to Python at a time. A batch of whole texts is held by the task's JVM thread and by
# its worker, beside the operators' own tables; Spark's 10,000 rows are tens of MB in each.
ARROW_ROWS = "1000"

# Tasks that list folders together. Spark's 10,000 are a task for each of thousands of folders, which takes
# far longer than the listing.
LISTING_TASKS = "200"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Settings the library expects. ANSI stays on: every cast that may see bad text
# is a try_* form, so a bad value gives NULL for that row instead of failing
# the job.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS,
    LISTING: LISTING_TASKS,
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Texts for a few folders go to as many open files of a task, instead of being sorted by folder first;
# a task that meets more folders sorts the rest.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "32"}


def build_session(
    master: str = "local[*]",
    app_name: str = "silverline",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SILVERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Reliable checkpoints of DataFrames that are gone are removed again.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the time zone, the batches to Python and the listing tasks on a session we did not build (e.g. the driver's)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set(LISTING, LISTING_TASKS)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS / object store). A local test session
    without one gets a fresh folder; that is the only place a local default
    is chosen.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Read the session's checkpoint folder; set one only for local runs."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application folder; keep its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
            "checkpoints and staged output."
        )
    local = tempfile.mkdtemp(prefix="silverline-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)  # noqa: SLF001


def stage_rows(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet to ``path`` and read back.

    Column by column, texts, repeated paths and keys take a small part of the disk that the plain rows of
    a reliable checkpoint or a cache take, a pass reads only its columns, and no executor holds anything.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """``stage_rows`` under the shared checkpoint root; the files go when the block ends."""
    path = scratch_path(df.sparkSession, purpose)
    try:
        yield stage_rows(df, path)
    finally:
        remove_folder(df.sparkSession, path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session's settings inside the block; the earlier ones come back after it."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, setting in wanted.items():
        spark.conf.set(name, setting)
    try:
        yield
    finally:
        for name, setting in before.items():
            spark.conf.set(name, setting) if setting is not None else spark.conf.unset(name)


def release_files(spark: SparkSession) -> None:
    """Let go of the shuffle files and checkpoints of frames that nobody holds any more.

    Spark removes them when the driver has collected those frames, which nothing brings about in a
    job of many steps, so the files of all steps would lie on disk together. Spark's listeners hold the query that
    ended last, so a small one ends first.
    """
    spark.range(1).collect()
    gc.collect()
    spark._jvm.System.gc()  # noqa: SLF001


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder.

    Used where one intermediate result feeds two branches that must see the
    same rows (or where recomputing it would re-read a large input). It cuts
    the lineage, so a lost executor does not force recomputation from Bronze.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
