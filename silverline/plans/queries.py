"""Registered queries: each operator run over the driver's test tables.

Every query reads whole tables (no sampling, id subsets or row caps) and uses
the same library operators the Bronze -> Silver jobs use. Output columns are
flat (dates and timestamps as ISO text, arrays joined with ``|``) so they
compare one-to-one with the DuckDB twins in :mod:`silverline.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.contracts import DEDUP_KEYS, MISSING_CONTEXT_COLUMNS
from silverline.functions.columns import (
    date_from_path,
    date_partition,
    decoded_key,
    file_name,
    hour_partition,
    json_text_field,
    partition_value,
    region_code_list,
    region_from_path,
    safe_long,
    split_tags,
    to_bool,
    ydm_to_date,
)
from silverline.operators.bucketed import save_bucketed
from silverline.operators.categories import file_status, silver_categories
from silverline.operators.checksums import checked_differences, write_checked
from silverline.operators.cleanse import cleanse_videos
from silverline.operators.dedup import dedup_videos, keep_last, video_order
from silverline.operators.distribution import distribution_drift, metric_sketches
from silverline.operators.gold import (
    category_analytics,
    channel_analytics,
    combine_sources,
    compare_sources,
    current_categories,
    lookup_rollup,
    quality_report,
    trending_analytics,
)
from silverline.operators.history import category_analytics_as_of, category_validity
from silverline.operators.ingest import land_payloads, payload_manifest, run_report
from silverline.operators.project import (
    explode_items_outer,
    pad_to_contract,
    project_api_videos,
    project_csv_videos,
)
from silverline.operators.quality import (
    collect_quality_metrics,
    critical_invalid,
    enforce_gate,
    failed_columns,
    gate_verdict,
    keep_valid,
    negative_metric,
    quality_metrics,
)
from silverline.plans.standins import (
    events_as_api_rows,
    events_as_videos,
    nations_as_category_drops,
    orders_as_api_payloads,
    parts_as_category_files,
    write_category_drop,
    write_events_as_csv_bronze,
    write_orders_as_api_bronze,
    write_orders_as_drifting_api_bronze,
)
from silverline.plans.categories import CategoryJobConfig, run_categories
from silverline.plans.gold import GoldJobConfig, refresh_gold
from silverline.plans.ingestion import IngestionConfig, run_ingestion
from silverline.plans.videos import VideoJobConfig, gate_source, run_videos, silver_rows
from silverline.session import materialize, release_files, scratch_path, stage_rows
from silverline.sinks.silver import manifest, write_partitioned
from silverline.sources.bronze import read_api_videos, read_csv_videos
from silverline.sources.tables import table
from silverline.streaming.incremental import stream_api_videos, stream_categories
from silverline.streaming.latest import compact_changes, changes_path, latest_videos, read_changes, stream_latest_videos

Query = Callable[[SparkSession, str], DataFrame]
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _day(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _ts(c: str | Column) -> Column:
    return F.date_format(c, TS_TEXT)


# Nullable integer outputs are emitted as DOUBLE (exact below 2**53) on both
# sides of the oracle, so NULLs look the same to any comparison.
def _bool_text(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c, F.lit("true")).when(~c, F.lit("false"))


def flat_videos(df: DataFrame) -> DataFrame:
    """Silver video rows as comparable text/number columns (no run timestamps)."""
    return df.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "channel_title",
        "title",
        "description",
        "category_id",
        F.concat_ws("|", "tags").alias("tags"),
        "view_count",
        "like_count",
        F.col("dislike_count").cast("double").alias("dislike_count"),
        "comment_count",
    )


def cleansed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse_videos(events_as_videos(table(spark, sf_dir, "events")))


# -- flagship: Bronze-shaped rows -> gate -> valid -> dedup -------------------
def silver_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The video job on the events stand-in.

    Job 1 is one metrics aggregate and the gate (raises on failure); the
    returned plan is the valid, deduplicated Silver rows.
    """
    clean = cleansed_events(spark, sf_dir)
    enforce_gate(collect_quality_metrics(clean, "events_videos"))
    return flat_videos(dedup_videos(keep_valid(clean)).drop("_source_file"))


def dedup_latest_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED1 on every observation (no validity filter): one row per key."""
    raw = events_as_videos(table(spark, sf_dir, "events"))
    deduped = dedup_videos(raw, order=video_order(raw))
    return deduped.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        F.col("comment_count").alias("event_id"),
    )


def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1-AGG5 in one pass, with the gate verdict."""
    metrics = quality_metrics(cleansed_events(spark, sf_dir))
    return metrics.withColumn("verdict", gate_verdict())


def missing_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT4/AGG4: one row per context column with its NULL count."""
    metrics = quality_metrics(cleansed_events(spark, sf_dir))
    return metrics.unpivot(
        [], [f"missing_{c}" for c in MISSING_CONTEXT_COLUMNS], "metric", "missing_rows"
    ).select(
        F.regexp_replace("metric", "^missing_", "").alias("column_name"),
        "missing_rows",
    )


def gate_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QG2-QG5 per daily dataset (source, region, trending_date)."""
    clean = cleansed_events(spark, sf_dir)
    metrics = quality_metrics(clean, group_by=["source", "region", "trending_date"])
    return metrics.select(
        "source",
        "region",
        _day("trending_date").alias("trending_date"),
        "input_rows",
        "invalid_critical_rows",
        "invalid_critical_row_ratio",
        "invalid_numeric_rows",
        gate_verdict().alias("verdict"),
    )


def critical_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT3: the rows that survive the critical-field rule."""
    valid = keep_valid(cleansed_events(spark, sf_dir))
    return valid.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        F.col("comment_count").alias("event_id"),
    )


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD5 (ours): rejected rows with the list of failed critical columns."""
    clean = cleansed_events(spark, sf_dir)
    return clean.filter(critical_invalid()).select(
        F.col("comment_count").alias("event_id"),
        "source",
        "region",
        F.concat_ws(",", failed_columns()).alias("failed_columns"),
    )


def negative_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2 on customer balances: rows that would trip the negative-metric rule."""
    customer = table(spark, sf_dir, "customer")
    return customer.filter(negative_metric(["c_acctbal"])).select(
        "c_custkey", "c_nationkey", "c_acctbal"
    )


def explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN1 + PRJ2: nested API payloads exploded outer into the contract."""
    docs = orders_as_api_payloads(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    videos = project_api_videos(explode_items_outer(docs.select("_source_file", "items")))
    return videos.select(
        F.regexp_extract("_source_file", r"/(\d+)\.json$", 1).cast("bigint").alias("o_orderkey"),
        "video_id",
        "region",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "channel_id",
        "channel_title",
        "title",
        *[
            F.col(c).cast("double").alias(c)
            for c in ("category_id", "view_count", "like_count", "favorite_count", "comment_count")
        ],
        F.concat_ws("|", "tags").alias("tags"),
        "duration",
        "definition",
        _bool_text("caption").alias("caption"),
        _bool_text("licensed_content").alias("licensed_content"),
    )


def path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN1/FN2/FN18/FN19 on page URLs."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        partition_value("url", "page").alias("page_value"),
        partition_value("url", "ref").alias("ref_value"),
        _day(date_from_path("url")).alias("path_date"),
        file_name("url").alias("last_segment"),
        decoded_key("url").alias("decoded_url"),
    )


def split_tag_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN9 over whole document texts: tag count and a digest of every tag."""
    docs = table(spark, sf_dir, "documents")
    tags = split_tags("text")
    return docs.select(
        "doc_id",
        F.size(tags).alias("n_tags"),
        F.concat_ws(",", F.transform(tags, lambda t: F.md5(t.cast("binary")))).alias("tag_digests"),
        F.length(F.element_at(tags, -1)).alias("last_tag_chars"),
    )


def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN6/FN12/FN20: a JSON field as an integer, day and hour partitions."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        safe_long(json_text_field("props", "$.k")).alias("k"),
        date_partition("ts").alias("day"),
        hour_partition("ts").alias("hour"),
    )


def cleanse_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CLN1-CLN3 on customers shaped as padded video rows."""
    customer = table(spark, sf_dir, "customer")
    raw = customer.select(
        F.when(F.col("c_acctbal") < 0, F.lit(" YouTube_API ")).otherwise(F.lit(" Kaggle ")).alias(
            "source"
        ),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("region"),
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("video_id"),
        F.when(F.col("c_acctbal") < 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")))
        .alias("title"),
        F.when(F.col("c_acctbal") > 9000, F.lit("")).otherwise(F.col("c_mktsegment")).alias(
            "channel_title"
        ),
        F.concat(F.lit("\t"), F.col("c_name"), F.lit(" ")).alias("description"),
    )
    return cleanse_videos(raw, checked_at_column=None)


def to_bool_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN3/FLT6: free text and numbers to a three-valued flag."""
    labels = table(spark, sf_dir, "labels")
    raw = (
        F.when((F.col("toxic") == 1) & (F.col("quality") == 1), F.lit("maybe"))
        .when(F.col("toxic") == 1, F.lit("Y"))
        .when(F.col("quality") == 1, F.lit("YES"))
        .otherwise(F.lit("0"))
    )
    return labels.select(
        "doc_id",
        raw.alias("raw_text"),
        _bool_text(to_bool(raw)).alias("flag"),
        _bool_text(to_bool("quality")).alias("quality_flag"),
    )


def safe_integer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1: text to bigint dropping the decimal part; junk gives NULL."""
    orders = table(spark, sf_dir, "orders")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("-"), F.format_string("%.2f", "o_totalprice")))
        .when(F.col("o_orderstatus") == "F", F.format_string("%.2f", "o_totalprice"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit("x")))
    )
    return orders.select(
        "o_orderkey",
        raw.alias("raw_text"),
        safe_long(raw).cast("double").alias("as_long"),
    )


def ydm_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN4: ``yy.dd.mm`` text parsed back; short forms parse leniently (D3)."""
    orders = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yy.MM")).otherwise(
        F.date_format("o_orderdate", "yy.dd.MM")
    )
    return orders.select(
        "o_orderkey",
        raw.alias("raw_text"),
        _day(ydm_to_date(raw)).alias("parsed"),
        _day(ydm_to_date(raw, strict=True)).alias("strict_parsed"),
    )


def align_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1-2/GLD4: two sources padded to one contract and unioned."""
    events = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders")
    a = pad_to_contract(
        events.select(
            F.lit("kaggle").alias("source"),
            F.upper("event_type").alias("region"),
            F.col("user_id").cast("string").alias("video_id"),
            F.to_date("ts").alias("trending_date"),
            F.round(F.col("value") * 100).cast("bigint").alias("view_count"),
        )
    )
    b = pad_to_contract(
        orders.select(
            F.lit("youtube_api").alias("source"),
            F.upper(F.col("o_orderpriority").substr(3, 2)).alias("region"),
            F.col("o_custkey").cast("string").alias("video_id"),
            F.to_date("o_orderdate").alias("trending_date"),
            F.col("o_totalprice").cast("bigint").alias("view_count"),
        )
    )
    both = combine_sources(a, b)
    nulls = F.size(F.filter(F.array(*[F.col(c).isNull() for c in both.columns]), lambda x: x))
    return both.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        "view_count",
        nulls.alias("null_columns"),
    )


def keep_last_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED2: last turn per (conversation, role), whole texts kept."""
    conv = table(spark, sf_dir, "conversations")
    return keep_last(conv, ["conv_id", "role"], "turn").select("conv_id", "role", "turn", "text")


REGION_LIST_TEXT = " building, Machinery ,,household "


def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING3/FN17: keep rows whose code is in a parsed comma list."""
    customer = table(spark, sf_dir, "customer")
    codes = region_code_list(F.lit(REGION_LIST_TEXT))
    return customer.filter(F.array_contains(codes, F.upper("c_mktsegment"))).select(
        "c_custkey", "c_mktsegment"
    )


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4/AGG8: record counts per written unit (documents by source, lang)."""
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, ["source", "lang"], "documents").select(
        "dataset", "source", "lang", "record_count"
    )


def payload_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING5/AGG7: item count per payload from the raw JSON text."""
    import datetime as _dt

    docs = orders_as_api_payloads(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    payloads = docs.select(
        F.lit("trending_videos").alias("dataset"),
        F.regexp_extract("_source_file", "region=([^/]+)", 1).alias("region"),
        F.to_json(F.struct("items")).alias("payload"),
        "o_orderkey",
    )
    run_ts = _dt.datetime(2024, 1, 1, tzinfo=_dt.UTC)
    return payload_manifest(payloads, run_ts, "20240101T000000Z_00000000").select(
        "dataset", "region", "source", "item_count", F.col("run_id")
    ).groupBy("dataset", "region", "source", "run_id").agg(
        F.count(F.lit(1)).alias("payloads"), F.sum("item_count").alias("items")
    )


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING6: per run (day) and region: outcomes, 207 if anything failed."""
    events = table(spark, sf_dir, "events")
    attempts = events.select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.col("event_type").alias("region"),
        F.when(F.col("value") < 50, F.lit("trending_videos"))
        .otherwise(F.lit("video_categories"))
        .alias("dataset"),
        (F.col("value") > 200).alias("failed"),
    )
    return run_report(attempts).select(
        "run_id", "region", "videos_status", "categories_status", "status_code"
    )


def category_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QG7-QG10: per-file status of the part-based category files."""
    files = parts_as_category_files(table(spark, sf_dir, "part")).withColumn(
        "source", F.lit("kaggle")
    )
    return file_status(files).select("bronze_file", "status", "item_count")


def flatten_category_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ3/GEN2/DED2: good files to rows, last item per id per file."""
    files = parts_as_category_files(table(spark, sf_dir, "part")).withColumn(
        "source", F.lit("kaggle")
    )
    ok = file_status(files).filter(F.col("status") == "ok")
    return silver_categories(ok).select(
        "bronze_file",
        "region",
        "category_id",
        "category_title",
        "channel_id",
        _bool_text("assignable").alias("assignable"),
    )


def silver_event_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid, deduplicated events stand-in (the Silver input of the Gold queries)."""
    return dedup_videos(keep_valid(cleansed_events(spark, sf_dir)))


def trending_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD1 (ours)."""
    out = trending_analytics(silver_event_videos(spark, sf_dir))
    return out.select(
        "source",
        "region",
        _day("trending_date").alias("trending_date"),
        "videos",
        "channels",
        "total_views",
        "avg_views",
        "like_ratio",
    )


def channel_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD2 (ours): dense rank of channels by views within each region."""
    return channel_analytics(silver_event_videos(spark, sf_dir)).select(
        "region", "channel_title", "videos", "days_trending", "total_views", "view_rank"
    )


def category_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD3 (ours): views per category, nation names as the category lookup."""
    nation = table(spark, sf_dir, "nation")
    lookup = nation.select(
        F.col("n_nationkey").cast("bigint").alias("category_id"),
        F.col("n_name").alias("category_title"),
    )
    out = category_analytics(
        silver_event_videos(spark, sf_dir),
        lookup,
        group_keys=("region", "category_id"),
        join_keys=("category_id",),
    )
    return out.select(
        "region",
        "category_id",
        "category_title",
        "videos",
        "total_views",
        "view_share",
    )


def category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD3 shape (ours): customers per nation and region via lookup joins."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    out = lookup_rollup(
        customer,
        "c_nationkey",
        [
            F.count(F.lit(1)).alias("customers"),
            F.count_if(negative_metric(["c_acctbal"])).alias("negative_balances"),
        ],
        [(nation, "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")],
    )
    return out.select(
        F.col("r_name").alias("region_name"),
        F.col("n_name").alias("nation_name"),
        "customers",
        "negative_balances",
    )


def current_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 current view: latest row per (source, region, category_id) across files."""
    files = parts_as_category_files(table(spark, sf_dir, "part")).withColumn(
        "source", F.lit("kaggle")
    )
    rows = silver_categories(file_status(files).filter(F.col("status") == "ok"))
    return current_categories(rows).select(
        "region", "category_id", "category_title", "channel_id"
    )


def csv_bronze_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/PRJ1 on real files: events written as Bronze CSV, read back through
    the CSV reader, projected, cleansed, gated and deduplicated."""
    root = scratch_path(spark, "bronze-csv")
    path = write_events_as_csv_bronze(table(spark, sf_dir, "events"), root)
    clean = cleanse_videos(project_csv_videos(read_csv_videos(spark, path)))
    enforce_gate(collect_quality_metrics(clean, "kaggle_videos"))
    out = silver_rows(clean)
    return out.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "title",
        "channel_title",
        "category_id",
        F.concat_ws("|", "tags").alias("tags"),
        "view_count",
        "like_count",
        F.col("dislike_count").cast("double").alias("dislike_count"),
        "comment_count",
        _bool_text("comments_disabled").alias("comments_disabled"),
        _bool_text("ratings_disabled").alias("ratings_disabled"),
        _bool_text("video_error_or_removed").alias("video_error_or_removed"),
        "description",
        "thumbnail_url",
    )


def api_bronze_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2/GEN1/PRJ2 on real files: orders written as API JSON, read back
    through the API reader, exploded, gated and deduplicated."""
    root = scratch_path(spark, "bronze-api")
    path = write_orders_as_api_bronze(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), root)
    raw = read_api_videos(spark, path, multi_line=False)
    # Thousands of day folders: opened once, for the gate and the rows.
    release_files(spark)
    clean = stage_rows(cleanse_videos(project_api_videos(explode_items_outer(raw))), scratch_path(spark, "api-rows"))
    gate_source(clean, "youtube_api_videos", 0.05)
    out = silver_rows(clean)
    return out.select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "channel_id",
        "channel_title",
        "title",
        "category_id",
        F.concat_ws("|", "tags").alias("tags"),
        "view_count",
        "like_count",
        "favorite_count",
        "comment_count",
        "duration",
        "definition",
        _bool_text("caption").alias("caption"),
        _bool_text("licensed_content").alias("licensed_content"),
    )


def _video_payloads(orders: DataFrame, lineitem: DataFrame, title: str = "part ") -> DataFrame:
    """Orders as payload rows (region, dataset, payload)."""
    docs = orders_as_api_payloads(orders, lineitem, title)
    return docs.select(
        F.regexp_extract("_source_file", "region=([^/]+)", 1).alias("region"),
        F.lit("trending_videos").alias("dataset"),
        F.to_json(F.struct(F.lit("youtube#videoListResponse").alias("kind"), "items")).alias("payload"),
    )


def _run_ts(day: int, hour: int) -> _dt.datetime:
    return _dt.datetime(2024, 1, day, hour, 0, 0, tzinfo=_dt.UTC)


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING1/ING2/SRC2/SRC3/SRC7: both datasets land, the unchanged jobs run, Silver is counted."""
    videos = _video_payloads(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    files = parts_as_category_files(table(spark, sf_dir, "part"))
    categories = files.select(
        F.concat(F.lit("m"), F.substring(F.regexp_extract("bronze_file", "region=([a-z]+)", 1), 1, 1)).alias("region"),
        F.lit("video_categories").alias("dataset"),
        F.col("value").alias("payload"),
    )
    bronze, silver = scratch_path(spark, "landing"), scratch_path(spark, "landed-silver")
    land_payloads(
        videos.unionByName(categories), bronze, _run_ts(2, 3), "20240102T030000Z_00000000", compression="lz4"
    )
    release_files(spark)
    vcfg = VideoJobConfig(bronze, silver, source="youtube_api", write_report=False)
    run_videos(spark, vcfg)
    release_files(spark)
    ccfg = CategoryJobConfig(bronze, silver)
    run_categories(spark, ccfg)
    video_rows = spark.read.parquet(vcfg.silver_path).groupBy("region").agg(
        F.lit("trending_videos").alias("dataset"),
        F.count(F.lit(1)).alias("silver_rows"),
        F.min(_day("trending_date")).alias("landed_date"),
    )
    lineage = spark.read.parquet(ccfg.manifest_path)
    category_rows = lineage.groupBy("region").agg(
        F.lit("video_categories").alias("dataset"),
        F.sum("record_count").alias("silver_rows"),
        F.min(_day(date_from_path("bronze_object"))).alias("landed_date"),
    )
    return video_rows.unionByName(category_rows)


INGESTION_REGIONS = ("ur", "hi", "me", "no", "lo")


def ingestion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ING1-ING6 as the job runs them: three runs, one per order status, with every outcome.

    In the first run the videos of one region fail, and it is repeated under its run id after
    it ended between data and manifest; in the second one region's categories fail and another's
    are not asked for; the third has two regions only. What is landed is counted from the files.
    """
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    files = parts_as_category_files(table(spark, sf_dir, "part").withColumn("p_brand", F.lit("Brand#11")))
    number = F.regexp_extract("bronze_file", r"_(\d+)_category_id", 1).cast("int") % len(INGESTION_REGIONS)
    categories = materialize(
        files.select(
            F.get(F.array(*[F.lit(r) for r in INGESTION_REGIONS]), number).alias("region"),
            F.lit("video_categories").alias("dataset"),
            F.col("value").alias("payload"),
        )
    )
    bronze, reports = scratch_path(spark, "ingestion-bronze"), scratch_path(spark, "ingestion-reports")

    def run(day: int, status: str, asked: DataFrame, fails: Column, regions: str | None = None, land=land_payloads):
        chosen = orders.filter(F.col("o_orderstatus") == status)
        # Of other orders no line is nested.
        lines = lineitem.join(chosen, lineitem.l_orderkey == chosen.o_orderkey, "left_semi")
        videos = _video_payloads(chosen, lines)
        attempts = videos.unionByName(asked).withColumns(
            {
                "payload": F.when(~fails, F.col("payload")),
                "error_type": F.when(fails, F.lit("TimeoutError")),
                "message": F.when(fails, F.concat(F.lit("no answer for "), F.upper("region"))),
            }
        )
        cfg = IngestionConfig(bronze, reports, regions, compression="lz4")
        return run_ingestion(spark, attempts, cfg, _run_ts(day, 3), f"202401{day:02d}T030000Z_00000000", land)

    class EndedEarly(RuntimeError):
        pass

    def ends_early(*args, **kwargs):
        land_payloads(*args, **kwargs)
        raise EndedEarly

    is_video = F.col("dataset") == "trending_videos"
    no_videos = is_video & (F.col("region") == "hi")
    try:
        run(2, "F", categories, no_videos, land=ends_early)
    except EndedEarly:
        run(2, "F", categories, no_videos)
    run(3, "O", categories.filter(F.col("region") != "no"), ~is_video & (F.col("region") == "lo"))
    run(4, "P", categories, F.lit(False), regions=" ur, Me ,,")

    def report(name: str) -> DataFrame:
        return spark.read.parquet(f"{reports}/_reports/{name}")

    def of(dataset: str, column: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("dataset") == dataset, column)), F.lit(0))

    listed = report("payload_manifest").groupBy("run_id", "region").agg(
        of("trending_videos", F.lit(1)).alias("video_payloads"),
        of("trending_videos", F.col("item_count")).alias("video_items"),
        of("video_categories", F.lit(1)).alias("category_payloads"),
        of("video_categories", F.col("item_count")).alias("category_items"),
    )
    failures = report("ingestion_failures").groupBy("run_id", "region").agg(F.count(F.lit(1)).alias("failures"))
    folders = (f"{bronze}/youtube/api_raw/videos", f"{bronze}/youtube/api_raw/categories")
    found = [
        spark.read.text(path, lineSep="\x1e").select("run_id", F.upper("region").alias("region")) for path in folders
    ]
    landed = found[0].unionByName(found[1]).groupBy("run_id", "region").agg(F.count(F.lit(1)).alias("landed"))
    counts = ["video_payloads", "video_items", "category_payloads", "category_items", "failures", "landed"]
    keys = ["run_id", "region"]
    joined = report("ingestion_runs").join(listed, keys, "left").join(failures, keys, "left").join(landed, keys, "left")
    return joined.select(
        *keys, "videos_status", "categories_status", "status_code",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
    )


def category_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3/SRC7/SNK3/SNK4/QG7-QG11: category files with every defect through the job.

    Returns each file's status with the records that its manifest row counts.
    """
    # One brand, so a file holds all parts of 50 keys.
    good = parts_as_category_files(table(spark, sf_dir, "part").withColumn("p_brand", F.lit("Brand#11")))
    number = F.regexp_extract("bronze_file", r"_(\d+)_category_id", 1).cast("int") % 8
    files = good.select(
        # Every eighth file lands under a region in upper case.
        F.when(number == 5, F.lit("US")).otherwise(F.lit("us")).alias("region"),
        F.regexp_extract("bronze_file", r"/([^/]+)\.json$", 1).alias("file"),
        F.when(number == 1, F.lit("{not json"))
        .when(number == 2, F.lit('{"items": {"id": "1"}}'))
        .when(number == 3, F.lit('{"items": [{"id": "x"}]}'))
        .when(number == 4, F.lit('{"items": []}'))
        .when(number == 6, F.lit('{"items": null}'))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    bronze, silver = scratch_path(spark, "category-bronze"), scratch_path(spark, "category-silver")
    # Spark's text writer names its files .txt.
    cfg = CategoryJobConfig(bronze, silver, extensions=(".txt",))
    files.write.partitionBy("region", "file").text(cfg.input_paths()[0], lineSep="\x1e")
    run_categories(spark, cfg, raise_on_error=False)
    run_categories(spark, cfg, raise_on_error=False)  # a rerun leaves one row per file
    name = F.regexp_extract("path", "file=([^/]+)/", 1).alias("file")
    status = spark.read.parquet(cfg.status_path).withColumnRenamed("bronze_file", "path").select(
        name, "status", "item_count"
    )
    lineage = spark.read.parquet(cfg.manifest_path).withColumnRenamed("bronze_object", "path").select(
        name, "source", "region", "record_count"
    )
    rows = spark.read.parquet(cfg.output_path).agg(F.count(F.lit(1)).alias("all_rows"))
    total = lineage.agg(F.sum("record_count").alias("counted")).join(rows).select(
        (F.col("counted") == F.col("all_rows")).alias("counts_agree")
    )
    return status.join(lineage, "file", "left").join(F.broadcast(total)).select(
        "file", "status", F.col("item_count").cast("bigint").alias("item_count"), "source", "region",
        F.col("record_count").cast("double").alias("record_count"), "counts_agree",
    )


def video_job_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG6/QG12/GLD5: the CSV job's metrics record and its quarantined rows, on the events files."""
    bronze, silver = scratch_path(spark, "job-bronze"), scratch_path(spark, "job-silver")
    write_events_as_csv_bronze(table(spark, sf_dir, "events"), bronze)
    cfg = VideoJobConfig(bronze, silver, source="kaggle", kaggle_raw_prefix="youtube/raw", write_quarantine=True)
    run_videos(spark, cfg)
    rejected = spark.read.parquet(cfg.rejected_path).groupBy().agg(
        F.count(F.lit(1)).alias("rejected_rows"),
        F.count_if(F.array_contains("failed_columns", "video_id")).alias("rejected_video_id"),
        F.count_if(F.array_contains("failed_columns", "published_at")).alias("rejected_published_at"),
    )
    record = spark.read.parquet(cfg.report_path).select(
        "dataset", "input_rows", "invalid_rows_removed", "duplicate_rows_removed", "output_rows",
        "invalid_critical_row_ratio", "invalid_numeric_rows",
    )
    return record.join(F.broadcast(rejected))  # one row each


def stream_landed_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2 on driver data, against one batch over all drops.

    Hour 09 lands and is streamed; then hour 03 of the same day, older though it
    arrives later, with other titles, must lose; hour 15 must win; an empty response in
    between fails the gate and must not stop the rest.
    """
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    bronze, silver = scratch_path(spark, "stream-bronze"), scratch_path(spark, "stream-silver")
    cfg = VideoJobConfig(bronze, silver, source="youtube_api", write_report=False)

    def drop(payloads: DataFrame, hour: int) -> None:
        land_payloads(payloads, bronze, _run_ts(2, hour), f"20240102T{hour:02d}0000Z_00000000", compression="lz4")
        release_files(spark)
        stream_api_videos(spark, cfg, raise_on_error=False)
        release_files(spark)

    def some(line: int, title: str) -> DataFrame:
        lines = lineitem.filter(F.col("l_linenumber") == line)
        having = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_semi")
        return _video_payloads(having, lines, title)

    drop(_video_payloads(orders, lineitem), 9)
    drop(some(1, "late "), 3)
    empty = orders.groupBy(F.lower(F.substring("o_orderpriority", 3, 2)).alias("region")).agg(
        F.lit("trending_videos").alias("dataset"), F.lit('{"items": []}').alias("payload")
    )
    drop(empty, 12)
    drop(some(2, "update "), 15)
    return spark.read.parquet(cfg.silver_path).select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "title",
        "category_id",
        "view_count",
        "comment_count",
    )


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2 in a state store: the drops of ``stream_landed_videos`` as changed keys, then a run with none.

    ``changes`` counts how often a key was written: once per drop that has it, whatever
    else lies in its region. The current rows are read after compaction.
    """
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    bronze, silver = scratch_path(spark, "latest-bronze"), scratch_path(spark, "latest-silver")
    cfg = VideoJobConfig(bronze, silver, source="youtube_api", write_report=False)

    def drop(payloads: DataFrame, hour: int) -> None:
        land_payloads(payloads, bronze, _run_ts(2, hour), f"20240102T{hour:02d}0000Z_00000000", compression="lz4")
        release_files(spark)
        stream_latest_videos(spark, cfg)
        release_files(spark)

    def some(line: int, title: str) -> DataFrame:
        lines = lineitem.filter(F.col("l_linenumber") == line)
        having = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_semi")
        return _video_payloads(having, lines, title)

    drop(_video_payloads(orders, lineitem), 9)
    drop(some(1, "late "), 3)
    drop(some(2, "update "), 15)
    idle = sum(r["changed_keys"] for r in stream_latest_videos(spark, cfg))  # no new files
    changes = stage_rows(
        read_changes(spark, changes_path(cfg)).groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("changes")),
        scratch_path(spark, "latest-changes"),
    )
    release_files(spark)
    compact_changes(spark, cfg)
    release_files(spark)
    return latest_videos(spark, cfg).join(changes, DEDUP_KEYS).select(
        "source",
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        _ts("published_at").alias("published_at"),
        "title",
        "category_id",
        "view_count",
        "changes",
        F.lit(idle).cast("bigint").alias("idle_changes"),
    )


def stream_recovered_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10: a merge that ends inside its write, after a region lost its files, then the next run.

    The first drop is every order, the second the second lines anew. The write of the second is
    cut off; the replay must give what one batch over both drops gives.
    """
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    bronze, silver = scratch_path(spark, "recovered-bronze"), scratch_path(spark, "recovered-silver")
    cfg = VideoJobConfig(bronze, silver, source="youtube_api", write_report=False)

    class CutOff(RuntimeError):
        pass

    def cut_off(staged: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
        """Every touched region is without its files; the new ones never come."""
        write_partitioned(staged.filter("FALSE"), path, partition_by)
        hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/source=youtube_api")  # noqa: SLF001
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)  # noqa: SLF001
        raise CutOff("the executor and the driver are gone")

    def land(payloads: DataFrame, hour: int) -> None:
        release_files(spark)
        land_payloads(payloads, bronze, _run_ts(2, hour), f"20240102T{hour:02d}0000Z_00000000", compression="lz4")
        release_files(spark)

    land(_video_payloads(orders, lineitem), 9)
    stream_api_videos(spark, cfg)
    lines = lineitem.filter(F.col("l_linenumber") == 2)
    land(_video_payloads(orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left_semi"), lines, "update "), 15)
    try:
        stream_api_videos(spark, cfg, writer=cut_off)
    except Exception as exc:  # noqa: BLE001 - the stream wraps it
        if "CutOff" not in str(exc):
            raise
    release_files(spark)
    stream_api_videos(spark, cfg)
    return spark.read.parquet(cfg.silver_path).select(
        "region", "video_id", _ts("published_at").alias("published_at"), "title", "view_count"
    )


def _drifting_job(spark: SparkSession, sf_dir: str) -> VideoJobConfig:
    bronze, silver = scratch_path(spark, "drift-bronze"), scratch_path(spark, "drift-silver")
    write_orders_as_drifting_api_bronze(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), bronze)
    release_files(spark)
    cfg = VideoJobConfig(bronze, silver, source="youtube_api", write_report=False, write_drift=True)
    run_videos(spark, cfg)
    return cfg


def api_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2/D6: fields beyond the contract, per day, reported by the job that reads them."""
    cfg = _drifting_job(spark, sf_dir)
    return spark.read.parquet(cfg.drift_path).select(
        _day("trending_date").alias("trending_date"), "path", "status", "seen_type", "items"
    )


def api_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2/D6: the values of those fields, by the key of their Silver row."""
    cfg = _drifting_job(spark, sf_dir)
    in_silver = spark.read.parquet(cfg.silver_path).select("region", "video_id", "trending_date")
    return spark.read.parquet(cfg.rescued_path).select(
        "region", "video_id", "trending_date", F.explode("rescued").alias("path", "json")
    ).join(in_silver, ["region", "video_id", "trending_date"], "left_semi").select(
        "region", "video_id", _day("trending_date").alias("trending_date"), "path", "json"
    )


def stream_category_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1: two sources, two drops with defects, a replaced, a repaired and a broken file, then nothing new.

    Reference files come from all parts as of one brand, 50 keys a file; API files are the nations of
    each region. The last columns count the files of the second and third run.
    """
    bronze, silver = scratch_path(spark, "str1-bronze"), scratch_path(spark, "str1-silver")
    cfg = CategoryJobConfig(bronze, silver)
    reference, api = cfg.input_paths()
    part = table(spark, sf_dir, "part")
    good = materialize(
        parts_as_category_files(part.withColumn("p_brand", F.lit("Brand#11"))).select(
            F.lit("us").alias("region"), F.regexp_extract("bronze_file", r"/([^/]+)\.json$", 1).alias("file"), "value"
        )
    )
    number = F.regexp_extract("file", r"_(\d+)_category_id", 1).cast("int") % 4
    broken = F.lit("{not json")
    write_category_drop(good.withColumn("value", F.when(number == 1, broken).otherwise(F.col("value"))), reference, "drop1")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    item = F.struct(
        F.col("n_nationkey").cast("string").alias("id"),
        F.struct(F.col("n_name").alias("title"), F.lit(True).alias("assignable")).alias("snippet"),
    )
    payloads = nations.groupBy(F.lower(F.substring("r_name", 1, 2)).alias("region")).agg(
        F.lit("video_categories").alias("dataset"), F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload")
    )
    land_payloads(payloads, bronze, _run_ts(2, 3), "20240102T030000Z_00000000")
    seen = [stream_categories(spark, CategoryJobConfig(bronze, silver, extensions=(".json", ".txt")), raise_on_error=False)]
    # Files 0 come anew with fewer items, files 1 repaired, files 2 broken: those keep their rows.
    doc = F.parse_json("value")
    fewer = F.filter(F.variant_get(doc, "$.items", "array<variant>"), lambda x: F.variant_get(x, "$.snippet.assignable", "boolean"))
    second = good.filter(number < 3).withColumn(
        "value",
        F.when(number == 0, F.to_json(F.struct(F.transform(fewer, lambda x: x).alias("items"))))
        .when(number == 1, F.col("value"))
        .otherwise(broken),
    )
    write_category_drop(second, reference, "drop2")
    again = CategoryJobConfig(bronze, silver, extensions=(".json", ".txt"))
    seen += [stream_categories(spark, again, raise_on_error=False) for _ in range(2)]
    counted = spark.read.parquet(cfg.output_path)
    name = F.when(F.col("source") == "kaggle", F.col("bronze_file")).otherwise(F.lit("landed")).alias("file")
    rows = counted.groupBy("source", "region", name).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.sum("category_id").alias("id_sum")
    )
    return rows.withColumns(
        {
            "reference_files_seen": F.lit(seen[1]["files"]).cast("bigint"),
            "failed_then": F.lit(seen[1]["failed"]).cast("bigint"),
            "idle_files": F.lit(seen[2]["files"]).cast("bigint"),
        }
    )


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD1-GLD3 refreshed: Silver by day gains days and loses a region between two refreshes.

    The first Silver has no purchases after 2024-01-15. They come, clicks go; the second refresh
    reads those days for the daily table and the two regions for the others; the third finds nothing.
    """
    root, gold = scratch_path(spark, "refresh-silver"), scratch_path(spark, "refresh-gold")
    cfg = GoldJobConfig(root, gold)
    path = f"{root}/{cfg.silver_videos_prefix}"
    silver = materialize(silver_event_videos(spark, sf_dir))
    late = (F.col("region") == "PURCHASE") & (F.col("trending_date") > F.lit("2024-01-15").cast("date"))
    layout = ("source", "region", "trending_date")
    write_partitioned(silver.filter(~late), path, layout)
    runs = [refresh_gold(spark, cfg)]
    write_partitioned(silver.filter(late), path, layout)
    clicks = spark.read.parquet(path).filter("region = 'CLICK'").select("source").distinct()
    for row in clicks.collect():  # one row per source
        hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/source={row['source']}/region=CLICK")  # noqa: SLF001
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)  # noqa: SLF001
    runs += [refresh_gold(spark, cfg) for _ in range(2)]
    daily = spark.read.parquet(cfg.gold_path("trending_analytics")).select(
        F.lit("trending").alias("gold_table"), "region", _day("trending_date").alias("key"), "videos", "total_views"
    )
    channels = spark.read.parquet(cfg.gold_path("channel_analytics")).select(
        F.lit("channel").alias("gold_table"), "region", F.col("channel_title").alias("key"), "videos", "total_views"
    )
    counted = {
        name: F.lit(run["channel_analytics"]).cast("bigint")
        for name, run in zip(("first_regions", "second_regions", "third_regions"), runs)
    }
    return daily.unionByName(channels).withColumns(counted)


def compare_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD4 (ours): Silver events against the raw-events source, full outer."""
    silver = silver_event_videos(spark, sf_dir)
    raw = events_as_api_rows(table(spark, sf_dir, "events"))
    out = compare_sources(silver, raw, left_name="silver", right_name="raw")
    return out.select(
        "region",
        "video_id",
        _day("trending_date").alias("trending_date"),
        F.col("silver_views").cast("double").alias("silver_views"),
        F.col("raw_views").cast("double").alias("raw_views"),
        "presence",
    )


def source_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD4 by checksums: observations whose views differ between Silver and the raw source.

    Both sides are laid out with checksums; rows are read from the cells whose checksums differ.
    """
    keys = ["region", "video_id", "trending_date"]
    sides = (silver_event_videos(spark, sf_dir), events_as_api_rows(table(spark, sf_dir, "events")))
    paths = [scratch_path(spark, f"checked-{side}") for side in ("silver", "raw")]
    for rows, path in zip(sides, paths, strict=True):
        write_checked(rows.groupBy(*keys).agg(F.max("view_count").alias("views")), path, keys)
    return checked_differences(spark, *paths).select(
        "region", "video_id", _day("trending_date").alias("trending_date"), "views", "left_rows", "right_rows"
    )


def view_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD6: quantiles of views per source, region and day from sketches, and how far they moved since the day before."""
    out = distribution_drift(metric_sketches(cleansed_events(spark, sf_dir)))
    return out.withColumns({c: _day(c) for c in ("trending_date", "previous_day")})


def category_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9/GLD3: views per category under the title of the trending day; ids are renamed by three drops."""
    drops = nations_as_category_drops(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    out = category_analytics_as_of(
        silver_event_videos(spark, sf_dir),
        category_validity(drops, keys=["category_id"]),
        group_keys=("region", "category_id"),
        keys=["category_id"],
    )
    return out.withColumns({c: _day(c) for c in ("valid_from", "valid_to", "first_day", "last_day")})


def bucketed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD7: Silver and the raw source as bucketed tables with statistics, joined without a shuffle."""
    name, keys = f"bucketed_{uuid.uuid4().hex[:12]}", ["region", "video_id"]
    sides = (silver_event_videos(spark, sf_dir), events_as_api_rows(table(spark, sf_dir, "events")))
    tables = [f"{name}_silver", f"{name}_raw"]
    for rows, saved in zip(sides, tables, strict=True):
        save_bucketed(rows.select(*keys, "trending_date", "view_count"), saved, scratch_path(spark, saved), keys, 16)
    totals = [
        spark.table(saved).groupBy(*keys).agg(
            F.count_distinct("trending_date").alias(f"{side}_days"), F.sum("view_count").alias(f"{side}_views")
        )
        for side, saved in zip(("silver", "raw"), tables, strict=True)
    ]
    out = materialize(totals[1].join(totals[0], keys, "left"))
    for saved in tables:
        spark.sql(f"DROP TABLE {saved}")
    return out


def quality_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GLD6 (ours): AGG1-4 per (source, region)."""
    return quality_report(cleansed_events(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "silver_videos": silver_videos,
    "dedup_latest_per_day": dedup_latest_per_day,
    "dq_metrics": dq_metrics,
    "missing_by_column": missing_by_column,
    "gate_by_day": gate_by_day,
    "critical_filter": critical_filter,
    "quarantine_reasons": quarantine_reasons,
    "negative_metric_rows": negative_metric_rows,
    "explode_items_outer": explode_items,
    "path_extract": path_extract,
    "split_tags": split_tag_text,
    "json_field": json_field,
    "cleanse_text": cleanse_text,
    "to_bool": to_bool_text,
    "safe_integer": safe_integer_text,
    "ydm_date": ydm_date,
    "align_sources": align_sources,
    "keep_last": keep_last_turn,
    "region_filter": region_filter,
    "manifest_counts": manifest_counts,
    "payload_items": payload_items,
    "run_report": run_status,
    "category_file_status": category_files,
    "flatten_categories": flatten_category_items,
    "trending_analytics": trending_by_day,
    "channel_analytics": channel_ranking,
    "category_analytics": category_views,
    "gold_refresh": gold_refresh,
    "compare_sources": compare_two_sources,
    "csv_bronze_videos": csv_bronze_videos,
    "api_bronze_videos": api_bronze_videos,
    "landed_payloads": landed_payloads,
    "ingestion_runs": ingestion_runs,
    "category_job": category_job,
    "video_job_record": video_job_record,
    "stream_landed_videos": stream_landed_videos,
    "stream_recovered_videos": stream_recovered_videos,
    "stream_latest_videos": stream_latest,
    "stream_categories": stream_category_files,
    "api_drift": api_drift,
    "api_rescued": api_rescued,
    "category_rollup": category_rollup,
    "current_categories": current_category_rows,
    "quality_by_partition": quality_by_partition,
    "source_differences": source_differences,
    "view_distribution": view_distribution,
    "category_history": category_history,
    "bucketed_sources": bucketed_sources,
}
