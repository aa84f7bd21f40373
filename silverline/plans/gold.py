"""The Gold job (ours; the reference only names these tables): Silver -> Gold.

Reads Silver videos (and categories when present) with partition filters, so
a run for some regions reads only their folders, and writes each table with
dynamic partition overwrite, so that run replaces only those regions.

``refresh_gold`` finds out by itself what to read: every refresh keeps a signature
of each Silver folder's files, and the next one reads and replaces only what belongs to
folders whose signature is another. Its rows are staged and marked before any Gold
table is written, so a refresh that ended inside its writes is finished by the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.contracts import CATEGORIES_OUTPUT_PREFIX, SILVER_VIDEOS_PREFIX
from silverline.operators.gold import (
    category_analytics,
    channel_analytics,
    current_categories,
    trending_analytics,
)
from silverline.session import materialize
from silverline.sinks.silver import write_partitioned
from silverline.sources.bronze import join_path


@dataclass
class GoldJobConfig:
    silver_root: str
    gold_root: str
    regions: Sequence[str] | None = None  # upper-case video regions; None = all
    silver_videos_prefix: str = SILVER_VIDEOS_PREFIX
    categories_prefix: str = CATEGORIES_OUTPUT_PREFIX

    def gold_path(self, name: str) -> str:
        return join_path(self.gold_root, name)


def read_silver_videos(spark: SparkSession, path: str, regions: Sequence[str] | None = None) -> DataFrame:
    """Silver videos; a region list becomes a partition filter (folder pruning)."""
    df = spark.read.parquet(path)
    if regions:
        df = df.filter(F.col("region").isin([r.upper() for r in regions]))
    return df


def read_silver_categories(spark: SparkSession, path: str, regions: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if regions:
        df = df.filter(F.col("region").isin([r.lower() for r in regions]))
    return current_categories(df)


def run_gold(spark: SparkSession, cfg: GoldJobConfig) -> list[str]:
    """Write the Gold tables; returns the names written."""
    videos = read_silver_videos(
        spark, join_path(cfg.silver_root, cfg.silver_videos_prefix), cfg.regions
    )
    written = []
    write_partitioned(trending_analytics(videos), cfg.gold_path("trending_analytics"), ("source", "region"))
    written.append("trending_analytics")
    write_partitioned(channel_analytics(videos), cfg.gold_path("channel_analytics"), ("region",))
    written.append("channel_analytics")
    categories_path = join_path(cfg.silver_root, cfg.categories_prefix)
    if _exists(spark, categories_path):
        categories = read_silver_categories(spark, categories_path, cfg.regions)
        write_partitioned(
            category_analytics(videos, categories), cfg.gold_path("category_analytics"), ("source", "region")
        )
        written.append("category_analytics")
    return written


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm  # noqa: SLF001
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)  # noqa: SLF001


def _has_files(spark: SparkSession, path: str) -> bool:
    """Is there a Parquet file under ``path``?"""
    return _exists(spark, path) and not _files(spark, path).select("path").isEmpty()


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet files under ``path`` with their partition columns; contents are read only if asked for."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)


def _delete(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)  # noqa: SLF001


# Incremental refresh ---------------------------------------------------------
GOLD_PARTITIONS = {
    "trending_analytics": ("source", "region"),
    "channel_analytics": ("region",),
    "category_analytics": ("source", "region"),
}
STATE_SCHEMA = "dataset string, source string, region string, day string, signature bigint, files bigint"


class _Folder:
    """One folder of the refresh log, by version: staged rows, then the marks ``whole`` and ``done``."""

    def __init__(self, spark: SparkSession, root: str, version: int):
        self.spark, self.version, self.path = spark, version, f"{root}/{version:012d}"

    def _hadoop(self, name: str):
        hpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")  # noqa: SLF001
        return hpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), hpath  # noqa: SLF001

    def has(self, name: str) -> bool:
        fs, hpath = self._hadoop(name)
        return fs.exists(hpath)

    def mark(self, name: str) -> None:
        fs, hpath = self._hadoop(name)
        fs.create(hpath, True).close()

    def put(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")

    def rows(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def delete(self) -> None:
        _delete(self.spark, self.path)


def _log(spark: SparkSession, root: str) -> list[_Folder]:
    """The refresh log's folders, oldest first: the last refresh and at most one unfinished."""
    if not _exists(spark, root):
        return []
    hpath = spark._jvm.org.apache.hadoop.fs.Path(root)  # noqa: SLF001
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    names = sorted(s.getPath().getName() for s in fs.listStatus(hpath))
    return [_Folder(spark, root, int(n)) for n in names if n.isdigit()]


def folder_signatures(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Per (source, region[, day]) folder: an order-free signature of its files' names, sizes and times.

    Only the file listing is read, no contents. ``day`` is null where days are not folders.
    """
    empty = spark.createDataFrame([], STATE_SCHEMA)
    if not _exists(spark, path):
        return empty
    files = _files(spark, path)
    if "region" not in files.columns:
        return empty
    day = F.col("trending_date").cast("string") if "trending_date" in files.columns else F.lit(None).cast("string")
    return (
        files.groupBy(
            F.lit(dataset).alias("dataset"),
            F.col("source").cast("string").alias("source"),
            F.upper(F.col("region").cast("string")).alias("region"),
            day.alias("day"),
        )
        .agg(
            F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("signature"),
            F.count(F.lit(1)).alias("files"),
        )
        .select("dataset", "source", "region", "day", "signature", "files")
    )


def touched_folders(before: DataFrame, now: DataFrame) -> DataFrame:
    """Per dataset, source and region with a new, changed or gone folder: the first and last such day."""
    keys = ["dataset", "source", "region", "day", "signature", "files"]
    differing = before.unionByName(now).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 1)
    return differing.groupBy("dataset", "source", "region").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


def _any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _pair(row) -> Column:
    return F.col("source").eqNullSafe(F.lit(row["source"])) & F.col("region").eqNullSafe(F.lit(row["region"]))


def in_touched(rows: Sequence, by_day: bool = False) -> Column:
    """Predicate on partition columns only, so that it prunes folders; ``rows`` of ``touched_folders``."""
    conditions = []
    for row in rows:
        c = _pair(row)
        if by_day and row["first_day"] is not None:
            c = c & F.col("trending_date").between(
                F.lit(row["first_day"]).cast("date"), F.lit(row["last_day"]).cast("date")
            )
        conditions.append(c)
    return _any_of(conditions)


def refresh_gold(spark: SparkSession, cfg: GoldJobConfig, writer=write_partitioned) -> dict:
    """Bring Gold up to date with Silver; reads the touched folders only.

    What is touched comes to the driver as one row per source and region, a number that
    does not grow with the videos; it becomes the scans' partition filters. Where Silver has day folders,
    ``trending_analytics`` reads a pair's days from the first to the last touched one and keeps its other
    days. The other tables are sums over days, so they read whole regions. Gold partitions
    without a row left are removed. ``cfg.regions`` is not used: a refresh covers Silver.
    Returns the number of refreshed partitions per table, and whether an earlier refresh was finished first.
    """
    log_root = cfg.gold_path("_refresh")
    log = _log(spark, log_root)
    unfinished = [f for f in log if f.has("whole") and not f.has("done")]
    for folder in unfinished:
        _apply(spark, cfg, folder, writer)
    done = [f for f in log if f.has("done")]
    version = log[-1].version + 1 if log else 0
    state = done[-1].rows("folders") if done else spark.createDataFrame([], STATE_SCHEMA)

    videos_path = join_path(cfg.silver_root, cfg.silver_videos_prefix)
    categories_path = join_path(cfg.silver_root, cfg.categories_prefix)
    # Listed before Silver is read: what is written meanwhile is another signature next time.
    now = materialize(
        folder_signatures(spark, videos_path, "videos").unionByName(
            folder_signatures(spark, categories_path, "categories")
        )
    )
    touched = materialize(touched_folders(state, now))
    rows = touched.collect()  # sources x regions
    result = {name: 0 for name in GOLD_PARTITIONS} | {"version": version, "finished_earlier": bool(unfinished)}
    if not rows:
        return result
    of_videos = [r for r in rows if r["dataset"] == "videos"]
    folder = _Folder(spark, log_root, version)
    folder.put("folders", now)
    folder.put("touched", touched)
    if not now.filter(F.col("dataset") == "videos").isEmpty():
        videos = spark.read.parquet(videos_path)
        result |= _stage_tables(spark, cfg, folder, videos, of_videos, rows, categories_path)
    folder.mark("whole")
    _apply(spark, cfg, folder, writer)
    for old in log:
        old.delete()
    return result


def _stage_tables(spark, cfg, folder, videos, of_videos, rows, categories_path) -> dict[str, int]:
    counts = {}
    if of_videos:
        fresh = trending_analytics(videos.filter(in_touched(of_videos, by_day=True)))
        kept_path = cfg.gold_path("trending_analytics")
        if any(r["first_day"] is not None for r in of_videos) and _has_files(spark, kept_path):
            kept = spark.read.parquet(kept_path).filter(in_touched(of_videos) & ~in_touched(of_videos, by_day=True))
            fresh = fresh.unionByName(kept.select(*fresh.columns))
        folder.put("trending_analytics", fresh)
        counts["trending_analytics"] = len(of_videos)
        regions = {r["region"] for r in of_videos}
        folder.put(
            "channel_analytics",
            channel_analytics(videos.filter(_any_of([F.col("region").eqNullSafe(F.lit(x)) for x in regions]))),
        )
        counts["channel_analytics"] = len(regions)
    if _has_files(spark, categories_path):
        pairs = {(r["source"], r["region"]): r for r in rows}
        lower = {(r["region"] or "").lower() for r in rows}
        categories = spark.read.parquet(categories_path).filter(F.col("region").isin(sorted(lower)))
        folder.put(
            "category_analytics",
            category_analytics(videos.filter(in_touched(list(pairs.values()))), current_categories(categories)),
        )
        counts["category_analytics"] = len(pairs)
    return counts


def _apply(spark: SparkSession, cfg: GoldJobConfig, folder: _Folder, writer) -> None:
    """Overwrite Gold from a whole stage; can be repeated as often as it takes."""
    touched = folder.rows("touched")
    for name, keys in GOLD_PARTITIONS.items():
        path = cfg.gold_path(name)
        staged = folder.rows(name) if folder.has(name) else None
        of = touched if name == "category_analytics" else touched.filter(F.col("dataset") == "videos")
        if _has_files(spark, path):
            _remove_emptied(spark, path, of.select(*keys).distinct(), staged, keys)
        if staged is not None:
            writer(staged, path, keys)
    folder.mark("done")


def _remove_emptied(spark, path: str, touched: DataFrame, staged: DataFrame | None, keys: Sequence[str]) -> None:
    """Delete the Gold folders of touched partitions that have no row any more."""
    gone = touched
    if staged is not None:
        gone = touched.exceptAll(staged.select(*keys).distinct())
    folder = F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("folder")
    gold = spark.read.parquet(path).select(*keys, folder).distinct().alias("gold")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"gold.{k}").eqNullSafe(F.col(f"gone.{k}"))
    # At most one folder per source and region.
    for row in gold.join(gone.alias("gone"), same, "left_semi").select("folder").distinct().collect():
        _delete(spark, spark._jvm.java.net.URI(row["folder"]))  # noqa: SLF001
