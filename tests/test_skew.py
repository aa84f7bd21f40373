"""A key holding a third of all rows: dedup stays correct and ships little."""

import datetime as dt

from pyspark.sql import functions as F

from silverline.contracts import PROJECTED_VIDEO_COLUMNS, VIDEO_TYPES
from silverline.operators.dedup import dedup_videos, keep_last
from silverline.plans.diagnostics import shuffle_writes

PARTS = 8


def skewed(spark, n=30_000):
    """n rows over PARTS partitions; a third share one dedup key."""
    base = spark.range(n).repartition(PARTS)
    hot = F.col("id") % 3 == 0
    cols = {
        "source": F.lit("kaggle"),
        "region": F.lit("US"),
        "video_id": F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")),
        "trending_date": F.lit(dt.date(2024, 1, 1)),
        "published_at": F.timestamp_seconds(F.col("id")),
        "category_id": F.lit(1),
        "view_count": F.col("id"),
        "silver_ingestion_timestamp": F.current_timestamp(),
    }
    select = [
        (cols[c] if c in cols else F.lit(None)).cast(VIDEO_TYPES[c]).alias(c) for c in PROJECTED_VIDEO_COLUMNS
    ]
    return base.select(*select)


def test_hot_key_dedup_ships_one_row_per_partition(spark):
    df = skewed(spark)
    out = dedup_videos(df)
    rows = out.select("video_id", "view_count").collect()
    hot_rows = [r for r in rows if r.video_id == "hot"]
    assert len(rows) == 20_000 + 1
    assert hot_rows[0].view_count == 29_997  # latest published_at among the hot rows
    (shuffle,) = [s for s in shuffle_writes(out) if s["partitioning"] == "hashpartitioning"]
    # 20,000 distinct keys plus at most one hot row per map partition
    assert shuffle["records"] <= 20_000 + PARTS


def test_hot_key_keep_last_ships_one_row_per_partition(spark):
    df = spark.range(24_000).repartition(PARTS).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos")
    )
    out = keep_last(df, ["k"], "pos")
    got = {r.k: r.pos for r in out.collect()}
    assert got[-1] == 23_997 and len(got) == 16_000 + 1
    (shuffle,) = [s for s in shuffle_writes(out) if s["partitioning"] == "hashpartitioning"]
    assert shuffle["records"] <= 16_000 + PARTS
