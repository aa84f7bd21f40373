"""Latest row per key in a state store (STR2, DED1).

The other form of the video stream: instead of rewriting the Silver partitions that a
drop touches, a stateful aggregation keeps the winner of every dedup key (the
greatest in batch order, in update mode), so a micro-batch reads, holds and writes
the keys of its own rows and nothing else. Each batch's changed keys are one
folder of a change table; the current rows are the winners over all changes, which is what
the batch job keeps over all files.

State is one row per key, in RocksDB (off the executors' heap, on their disks, uploaded to
the stream's checkpoint), dealt by key; the number of state partitions is fixed by the first run's
``spark.sql.shuffle.partitions``. Rows that fail the critical rule never reach it; the
batch gate (QG2-QG5) belongs to ``stream_api_videos``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.contracts import DEDUP_KEYS, SILVER_VIDEO_COLUMNS
from silverline.operators.cleanse import cleanse_videos
from silverline.operators.project import explode_items_outer, project_api_videos
from silverline.operators.quality import keep_valid
from silverline.plans.videos import VideoJobConfig
from silverline.session import remove_folder, settings
from silverline.sources.bronze import SOURCE_FILE, join_path
from silverline.streaming.incremental import (
    BRONZE_KEY,
    _mkdirs,
    _run_available_now,
    api_video_stream,
    stream_checkpoint,
    stream_id,
)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# State is most of the stream's disk, in the local copy and in the checkpoint: packed tighter than by default,
# in blocks that hold enough rows to have something in common.
COMPRESSION = "spark.sql.streaming.stateStore.rocksdb.compression"
BLOCK_KB = "spark.sql.streaming.stateStore.rocksdb.blockSizeKB"
# The local copy of a run that has ended goes at the next maintenance.
MAINTENANCE = "spark.sql.streaming.stateStore.maintenanceInterval"
STATE = {PROVIDER: ROCKSDB, COMPRESSION: "zstd", BLOCK_KB: "64", MAINTENANCE: "15s"}
COMPACTED = "compacted"


def ranked(df: DataFrame) -> Column:
    """A row without its dedup key as one value, ordered as in a batch (``merge_order``), the winner the greatest.

    Publish time, the Bronze key from ``region=`` on and a hash of the content come first; what follows is
    equal where those are. What ranks the row is also a part of it, so nothing is kept twice: the
    Bronze key is cut in two where its rank begins.
    """
    hashed = [c for c in df.columns if not c.startswith("silver_") and c != BRONZE_KEY]
    whole = F.col(BRONZE_KEY)
    key = F.regexp_extract(whole, r"(region=.*)$", 1)
    root = F.substring(whole, F.lit(1), F.length(whole) - F.length(key))
    rest = [c for c in df.columns if c not in (*DEDUP_KEYS, "published_at", BRONZE_KEY)]
    return F.struct("published_at", key.alias("_key"), F.xxhash64(*hashed).alias("_content"), root.alias("_root"), *rest)


def winners(df: DataFrame) -> DataFrame:
    """The winning row per dedup key; stateful on a stream, two-phase aggregation on a table."""
    rest = [c for c in df.columns if c not in (*DEDUP_KEYS, BRONZE_KEY)]
    best = df.groupBy(*DEDUP_KEYS).agg(F.max(ranked(df)).alias("best"))
    bronze_key = F.concat("best._root", "best._key").alias(BRONZE_KEY)
    return best.select(*DEDUP_KEYS, *[F.col(f"best.{c}").alias(c) for c in rest], bronze_key)


def changes_path(cfg: VideoJobConfig) -> str:
    return join_path(cfg.silver_root, "_changes/videos")


def stream_latest_videos(
    spark: SparkSession,
    cfg: VideoJobConfig,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
) -> list[dict[str, Any]]:
    """New API drops -> the keys they touch, with their current winners. One record per batch."""
    path = changes_path(cfg)
    checkpoint = checkpoint or stream_checkpoint(spark, "latest_videos", path)
    source = join_path(cfg.bronze_root, cfg.api_videos_prefix)
    _mkdirs(spark, source)
    raw = api_video_stream(spark, source, max_files_per_trigger, multi_line)
    rows = keep_valid(cleanse_videos(project_api_videos(explode_items_outer(raw))))
    rows = rows.select(*SILVER_VIDEO_COLUMNS, F.col(SOURCE_FILE).alias(BRONZE_KEY))
    records: list[dict[str, Any]] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(spark, checkpoint)
        # A replay replaces its own folder; the state gives it the same rows.
        folder = change_folder(path, stream, batch_id)
        batch.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        n = spark.read.schema(batch.schema).parquet(folder).count()
        if n:
            records.append({"batch_id": batch_id, "changed_keys": n})
        else:
            remove_folder(spark, folder)

    with settings(spark, STATE):
        _run_available_now(winners(rows), handle, checkpoint, mode="update")
    return records


def change_folder(path: str, stream: str, batch_id: int) -> str:
    """The partition of one batch. Its rows are written straight to it: they need no sort or shuffle by a folder."""
    return f"{path}/stream_id={stream}/batch_id={batch_id}"


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes: Silver columns, Bronze key, stream and batch (a batch's folder is read alone)."""
    types = {"stream_id": "string", "batch_id": "bigint"}
    found = spark.read.parquet(path)
    return found.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def latest_videos(spark: SparkSession, cfg: VideoJobConfig) -> DataFrame:
    """The current rows: per key the winner over all changes, of whatever stream."""
    changes = read_changes(spark, changes_path(cfg)).select(*SILVER_VIDEO_COLUMNS, BRONZE_KEY)
    return winners(changes).select(*SILVER_VIDEO_COLUMNS, BRONZE_KEY)


def compact_changes(spark: SparkSession, cfg: VideoJobConfig) -> None:
    """Fold all changes into one folder.

    Winners of winners are winners, so the new folder may stand beside the old ones: it is
    written first, and a run that ends before the old ones are gone only leaves work to the next.
    """
    path = changes_path(cfg)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    old = [f.getPath() for s in fs.listStatus(jvm_path(path)) if s.isDirectory() for f in fs.listStatus(s.getPath())]
    numbers = [int(p.getName().partition("=")[2]) for p in old if p.getParent().getName() == f"stream_id={COMPACTED}"]
    folder = change_folder(path, COMPACTED, max(numbers, default=-1) + 1)
    latest_videos(spark, cfg).write.option("compression", "zstd").parquet(folder)
    for p in old:
        fs.delete(p, True)
