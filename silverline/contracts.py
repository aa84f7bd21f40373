"""Schemas, column lists and the fixed values every operator defaults to.

The operators take these lists as parameters, so the same code runs on Bronze
files and on the driver's test tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being matched; they are stated
# plainly and in their natural order.
# ---------------------------------------------------------------------------
SOURCES = ("kaggle", "youtube_api")
SOURCE_CHOICES = ("kaggle", "youtube_api", "all")
DEFAULT_REGION_CODES = "CA,DE,FR,GB,IN,JP,KR,MX,RU,US"
MAX_INVALID_ROW_RATIO = 0.05
MAX_RESULTS_LIMITS = (1, 50)
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
VIDEO_REGION_PATTERN = r"region=([^/]+)"
CATEGORY_REGION_PATTERN = r"region=([a-z]{2})"
DATE_PATTERN = r"date=([0-9-]+)"
KAGGLE_RAW_PREFIX = "youtube/raw"
API_VIDEOS_PREFIX = "youtube/api_raw/videos"
SILVER_VIDEOS_PREFIX = "youtube/videos"
REFERENCE_PREFIX = "youtube/raw_reference_data/"
API_CATEGORIES_PREFIX = "youtube/api_raw/categories/"
CATEGORIES_OUTPUT_PREFIX = "youtube/categories/"
API_SOURCE_LABEL = "youtube_data_api_v3"
VIDEOS_DATASET = "trending_videos"
CATEGORIES_DATASET = "video_categories"
STATUS_OK = 200
STATUS_PARTIAL = 207

REQUIRED_VIDEO_FIELDS = ["video_id", "category_id"]
REQUIRED_OBSERVATION_FIELDS = ["source", "region", "trending_date", "published_at"]
CRITICAL_COLUMNS = REQUIRED_VIDEO_FIELDS + REQUIRED_OBSERVATION_FIELDS
NUMERIC_COLUMNS = [
    "view_count",
    "like_count",
    "dislike_count",
    "favorite_count",
    "comment_count",
]
TEXT_COLUMNS = [
    "video_id",
    "channel_id",
    "channel_title",
    "title",
    "description",
    "thumbnail_url",
    "duration",
    "definition",
]
# Columns whose empty string becomes NULL: the critical ones, then these two.
BLANK_TO_NULL_COLUMNS = CRITICAL_COLUMNS + ["title", "channel_title"]
MISSING_CONTEXT_COLUMNS = [
    "video_id",
    "category_id",
    "region",
    "trending_date",
    "published_at",
    "title",
    "channel_title",
]
DEDUP_KEYS = ["source", "region", "video_id", "trending_date"]
CSV_REQUIRED_COLUMNS = [
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
]
# Selected by the CSV projection but not in the up-front check.
CSV_SELECTED_ONLY_COLUMNS = [
    "description",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
]
API_REQUIRED_COLUMNS = ["items"]
CATEGORY_KEYS = ["source", "region", "category_id"]
SILVER_PARTITION_COLUMNS = ("source", "region")
# ---------------------------------------------------------------------------

# The Silver video contract, in order (25 columns from the projections, then
# the cleansing timestamp).
SILVER_VIDEO_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("video_id", T.StringType()),
        T.StructField("trending_date", T.DateType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("channel_title", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("view_count", T.LongType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("dislike_count", T.LongType()),
        T.StructField("favorite_count", T.LongType()),
        T.StructField("comment_count", T.LongType()),
        T.StructField("thumbnail_url", T.StringType()),
        T.StructField("comments_disabled", T.BooleanType()),
        T.StructField("ratings_disabled", T.BooleanType()),
        T.StructField("video_error_or_removed", T.BooleanType()),
        T.StructField("duration", T.StringType()),
        T.StructField("definition", T.StringType()),
        T.StructField("caption", T.BooleanType()),
        T.StructField("licensed_content", T.BooleanType()),
        T.StructField("silver_ingestion_timestamp", T.TimestampType()),
        T.StructField("silver_quality_checked_at", T.TimestampType()),
    ]
)
PROJECTED_VIDEO_COLUMNS = [f.name for f in SILVER_VIDEO_SCHEMA.fields[:25]]
SILVER_VIDEO_COLUMNS = [f.name for f in SILVER_VIDEO_SCHEMA.fields]
VIDEO_TYPES = {f.name: f.dataType for f in SILVER_VIDEO_SCHEMA.fields}

# Explicit API schema (decision D6): no inference scan, and a missing `tags`
# in every item still resolves. Leaves are text; counts are cast later.
API_ITEM_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("publishedAt", T.StringType()),
                    T.StructField("channelId", T.StringType()),
                    T.StructField("channelTitle", T.StringType()),
                    T.StructField("title", T.StringType()),
                    T.StructField("description", T.StringType()),
                    T.StructField("categoryId", T.StringType()),
                    T.StructField("tags", T.ArrayType(T.StringType())),
                    T.StructField(
                        "thumbnails",
                        T.StructType(
                            [
                                T.StructField(
                                    "default",
                                    T.StructType([T.StructField("url", T.StringType())]),
                                )
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "statistics",
            T.StructType(
                [
                    T.StructField("viewCount", T.StringType()),
                    T.StructField("likeCount", T.StringType()),
                    T.StructField("favoriteCount", T.StringType()),
                    T.StructField("commentCount", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "contentDetails",
            T.StructType(
                [
                    T.StructField("duration", T.StringType()),
                    T.StructField("definition", T.StringType()),
                    T.StructField("caption", T.StringType()),
                    T.StructField("licensedContent", T.StringType()),
                ]
            ),
        ),
    ]
)
API_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("items", T.ArrayType(API_ITEM_SCHEMA)),
    ]
)

CATEGORY_ITEM_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet",
            T.StructType(
                [
                    T.StructField("channelId", T.StringType()),
                    T.StructField("title", T.StringType()),
                    T.StructField("assignable", T.BooleanType()),
                ]
            ),
        ),
    ]
)
CATEGORY_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("items", T.ArrayType(CATEGORY_ITEM_SCHEMA)),
    ]
)

SILVER_CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_title", T.StringType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("assignable", T.BooleanType()),
    ]
)
SILVER_CATEGORY_COLUMNS = [f.name for f in SILVER_CATEGORY_SCHEMA.fields]
