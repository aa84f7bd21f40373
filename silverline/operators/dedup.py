"""Keep-one-per-key operators (DED1, DED2, FLT5, SRT1).

Both are ``row_number() = 1`` over a window. Spark turns that filter into a
``WindowGroupLimit`` that also runs *before* the shuffle, so each map task
sends at most one row per key: a key holding a third of all rows costs one row
per input partition on the wire, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverline.contracts import DEDUP_KEYS

RANK_COLUMN = "_dedup_rank"


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """The first row per key under ``order`` (ties broken by ``order`` only)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(RANK_COLUMN, F.row_number().over(window))
        .filter(F.col(RANK_COLUMN) == 1)
        .drop(RANK_COLUMN)
    )


def video_order(
    df: DataFrame,
    source_file_column: str = "_source_file",
    content_hash: bool = True,
    exclude_from_hash: Sequence[str] = (
        "silver_ingestion_timestamp",
        "silver_quality_checked_at",
    ),
) -> list[Column]:
    """DED1 order, made deterministic (decision D5).

    published_at desc, silver_ingestion_timestamp desc (both nulls last), as
    the reference. Its second key never decides (one timestamp per query), so
    the source file path (later hourly drops sort later) and a content hash
    follow. A tie after all of that is an exact copy, so any survivor is equal.
    """
    order = [
        F.col("published_at").desc_nulls_last(),
        F.col("silver_ingestion_timestamp").desc_nulls_last(),
    ]
    if source_file_column in df.columns:
        order.append(F.col(source_file_column).desc_nulls_last())
    if content_hash:
        hashed = [c for c in df.columns if c not in set(exclude_from_hash)]
        order.append(F.xxhash64(*hashed).desc())
    return order


def merge_order(df: DataFrame, source_file_column: str = "_source_file") -> list[Column]:
    """DED1 order over rows of several runs: equal to one batch over all their files.

    In a batch all rows share one ingestion time, so after published_at the Bronze
    key decides. Across runs the ingestion time tells only when a file was
    read, not which drop is newer, so it must not come before the key.
    """
    key = F.regexp_extract(F.col(source_file_column), r"(region=.*)$", 1)
    hashed = [c for c in df.columns if not c.startswith("silver_") and c != source_file_column]
    return [
        F.col("published_at").desc_nulls_last(),
        key.desc_nulls_last(),
        F.xxhash64(*hashed).desc(),
    ]


def dedup_videos(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """DED1: one row per (source, region, video_id, trending_date)."""
    return first_per_key(df, keys, order if order is not None else video_order(df))


def keep_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """DED2: the last row per key in file order (pandas ``keep="last"``)."""
    return first_per_key(df, keys, [F.col(position).desc()])


def current_version(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Latest row per key by a version column such as the Bronze file (D9)."""
    return first_per_key(df, keys, [F.col(version).desc_nulls_last()])
