"""Projections onto the Silver contracts (PRJ1-PRJ5, GEN1, GEN2).

Each is a single ``select`` over the raw frame, so Catalyst prunes every raw
column the contract does not use and the JSON/CSV parsers skip converting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.contracts import PROJECTED_VIDEO_COLUMNS, VIDEO_TYPES
from silverline.functions.columns import (
    category_region_from_path,
    date_from_path,
    empty_array_if_null,
    iso_timestamp,
    region_from_path,
    safe_boolean,
    safe_int,
    safe_long,
    split_tags,
    to_bool,
    ydm_to_date,
)

SOURCE_FILE = "_source_file"
PATH_REGION, PATH_DATE = "_path_region", "_path_date"


def _typed_null(name: str) -> Column:
    return F.lit(None).cast(VIDEO_TYPES[name])


def _ordered(columns: dict[str, Column], keep_source_file: bool) -> list[Column]:
    out = [columns[name].alias(name) for name in PROJECTED_VIDEO_COLUMNS]
    if keep_source_file:
        out.append(F.col(SOURCE_FILE))
    return out


# PRJ1 ----------------------------------------------------------------------
def project_csv_videos(
    raw: DataFrame,
    source_label: str = "kaggle",
    strict_dates: bool = False,
    normalize_tags: bool = False,
    keep_source_file: bool = True,
) -> DataFrame:
    """CSV rows (all text) onto the 25-column contract."""
    c = F.col
    columns = {
        "source": F.lit(source_label),
        "region": region_from_path(SOURCE_FILE),
        "video_id": c("video_id"),
        "trending_date": ydm_to_date("trending_date", strict=strict_dates),
        "published_at": iso_timestamp("publish_time"),
        "channel_id": _typed_null("channel_id"),
        "channel_title": c("channel_title"),
        "title": c("title"),
        "description": c("description"),
        "category_id": safe_int("category_id"),
        "tags": split_tags("tags", normalize=normalize_tags),
        "view_count": safe_long("views"),
        "like_count": safe_long("likes"),
        "dislike_count": safe_long("dislikes"),
        "favorite_count": _typed_null("favorite_count"),
        "comment_count": safe_long("comment_count"),
        "thumbnail_url": c("thumbnail_link"),
        "comments_disabled": to_bool("comments_disabled"),
        "ratings_disabled": to_bool("ratings_disabled"),
        "video_error_or_removed": to_bool("video_error_or_removed"),
        "duration": _typed_null("duration"),
        "definition": _typed_null("definition"),
        "caption": _typed_null("caption"),
        "licensed_content": _typed_null("licensed_content"),
        "silver_ingestion_timestamp": F.current_timestamp(),
    }
    return raw.select(*_ordered(columns, keep_source_file))


# GEN1 + PRJ2 ---------------------------------------------------------------
def explode_items_outer(raw: DataFrame, items: str = "items", item: str = "item") -> DataFrame:
    """One row per item; a NULL or empty list still yields one all-NULL row.

    ``_items_present`` remembers whether the document had an ``items`` value,
    so the "column missing in every document" check rides on the metrics pass.
    Region and day of the file's path are read once a document, not once an item.
    """
    if SOURCE_FILE in raw.columns:
        # In a select of its own, below the explode: beside it Spark evaluates them per item.
        raw = raw.select(
            "*", region_from_path(SOURCE_FILE).alias(PATH_REGION), date_from_path(SOURCE_FILE).alias(PATH_DATE)
        )
    return raw.select(
        "*",
        F.col(items).isNotNull().alias("_items_present"),
        F.explode_outer(items).alias(item),
    ).drop(items)


def project_api_videos(
    exploded: DataFrame,
    source_label: str = "youtube_api",
    keep_source_file: bool = True,
    item: str = "item",
) -> DataFrame:
    """Exploded API items onto the same 25 columns (nested field access)."""

    def f(path: str) -> Column:
        return F.col(f"{item}.{path}")

    read = PATH_REGION in exploded.columns
    columns = {
        "source": F.lit(source_label),
        "region": F.col(PATH_REGION) if read else region_from_path(SOURCE_FILE),
        "video_id": f("id"),
        # The API has no trending date: the day observed in the Bronze path.
        "trending_date": F.col(PATH_DATE) if read else date_from_path(SOURCE_FILE),
        "published_at": iso_timestamp(f("snippet.publishedAt")),
        "channel_id": f("snippet.channelId"),
        "channel_title": f("snippet.channelTitle"),
        "title": f("snippet.title"),
        "description": f("snippet.description"),
        "category_id": safe_int(f("snippet.categoryId")),
        "tags": empty_array_if_null(f("snippet.tags")),
        "view_count": safe_long(f("statistics.viewCount")),
        "like_count": safe_long(f("statistics.likeCount")),
        "dislike_count": _typed_null("dislike_count"),
        "favorite_count": safe_long(f("statistics.favoriteCount")),
        "comment_count": safe_long(f("statistics.commentCount")),
        "thumbnail_url": f("snippet.thumbnails.default.url"),
        "comments_disabled": _typed_null("comments_disabled"),
        "ratings_disabled": _typed_null("ratings_disabled"),
        "video_error_or_removed": _typed_null("video_error_or_removed"),
        "duration": f("contentDetails.duration"),
        "definition": f("contentDetails.definition"),
        "caption": to_bool(f("contentDetails.caption")),
        "licensed_content": safe_boolean(f("contentDetails.licensedContent")),
        "silver_ingestion_timestamp": F.current_timestamp(),
    }
    out = _ordered(columns, keep_source_file)
    if "_items_present" in exploded.columns:
        out.append(F.col("_items_present"))
    return exploded.select(*out)


# GEN2 + PRJ3 ---------------------------------------------------------------
def flatten_categories(
    files: DataFrame,
    payload: str = "payload",
    file_column: str = "bronze_file",
    source_column: str = "source",
) -> DataFrame:
    """Category items to rows, with their position for keep-last.

    ``posexplode`` drops files with an empty or NULL list (those are reported
    by the file status). A missing ``snippet`` reads as empty.
    """
    exploded = files.select(
        F.col(file_column),
        F.col(source_column),
        category_region_from_path(file_column).alias("region"),
        F.posexplode(f"{payload}.items").alias("pos", "item"),
    )
    return exploded.select(
        file_column,
        source_column,
        "region",
        "pos",
        F.trim(F.col("item.id")).try_cast("bigint").alias("category_id"),
        F.col("item.snippet.title").alias("category_title"),
        F.col("item.snippet.channelId").alias("channel_id"),
        F.col("item.snippet.assignable").alias("assignable"),
    )


def pad_to_contract(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Union helper (GLD4): any subset of the contract, typed NULLs elsewhere."""
    present = set(df.columns)
    cols = [
        F.col(n).cast(VIDEO_TYPES[n]).alias(n) if n in present else _typed_null(n).alias(n)
        for n in PROJECTED_VIDEO_COLUMNS
    ]
    return df.select(*cols, *keep)
