"""Command line: ``python -m silverline <job> --bronze ROOT --silver ROOT ...``.

Jobs: ``videos``, ``categories``, ``stream-videos``, ``stream-categories``,
``gold`` (``--gold ROOT``, optional ``--regions US,GB``).
Upper-case option names (``--SOURCE``, ``--MAX_INVALID_ROW_RATIO``,
``--BRONZE_BUCKET`` ...) are accepted too, so an existing job invocation
carries over. The session comes from ``spark-submit`` (cluster settings,
``spark.checkpoint.dir``); only the time zone is pinned.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from silverline.contracts import (
    API_CATEGORIES_PREFIX,
    API_VIDEOS_PREFIX,
    CATEGORIES_OUTPUT_PREFIX,
    KAGGLE_RAW_PREFIX,
    MAX_INVALID_ROW_RATIO,
    REFERENCE_PREFIX,
    SILVER_VIDEOS_PREFIX,
)


def _root(value: str) -> str:
    return value if "://" in value or value.startswith("/") else f"s3://{value}"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="silverline")
    p.add_argument("job", choices=["videos", "categories", "stream-videos", "stream-categories", "gold"])
    p.add_argument("--bronze", "--BRONZE_BUCKET", dest="bronze", required=True, type=_root)
    p.add_argument("--silver", "--SILVER_BUCKET", dest="silver", required=True, type=_root)
    p.add_argument("--source", "--SOURCE", dest="source", default="all")
    p.add_argument(
        "--max-invalid-row-ratio", "--MAX_INVALID_ROW_RATIO", dest="ratio", type=float,
        default=MAX_INVALID_ROW_RATIO,
    )
    p.add_argument("--kaggle-raw-prefix", "--KAGGLE_RAW_PREFIX", dest="kaggle_prefix", default=KAGGLE_RAW_PREFIX)
    p.add_argument("--api-videos-prefix", "--API_VIDEOS_PREFIX", dest="api_prefix", default=API_VIDEOS_PREFIX)
    p.add_argument(
        "--silver-videos-prefix", "--SILVER_VIDEOS_PREFIX", dest="silver_prefix", default=SILVER_VIDEOS_PREFIX
    )
    p.add_argument("--reference-prefix", "--REFERENCE_PREFIX", dest="ref_prefix", default=REFERENCE_PREFIX)
    p.add_argument(
        "--api-categories-prefix", "--API_CATEGORIES_PREFIX", dest="api_cat_prefix", default=API_CATEGORIES_PREFIX
    )
    p.add_argument(
        "--categories-output-prefix", "--CATEGORIES_OUTPUT_PREFIX", dest="cat_out_prefix",
        default=CATEGORIES_OUTPUT_PREFIX,
    )
    p.add_argument("--gold", dest="gold", type=_root, help="Gold root (gold job)")
    p.add_argument("--regions", dest="regions", default="", help="comma list for the gold job")
    p.add_argument("--refresh", dest="refresh", action="store_true", help="gold: only what changed in Silver")
    p.add_argument("--strict-dates", action="store_true")
    p.add_argument("--normalize-tags", action="store_true")
    p.add_argument("--partition-by-day", action="store_true", help="Silver videos also by trending_date")
    p.add_argument("--single-line-api", action="store_true", help="API files are JSON Lines and may be split")
    p.add_argument("--write-drift", action="store_true", help="also report and keep API fields beyond the contract")
    p.add_argument("--write-quarantine", action="store_true", help="also write the rows that the gate's rules reject")
    p.add_argument("--catalog", default="", help="database in which the Silver tables are registered")
    p.add_argument("--single-line-csv", action="store_true", help="CSV fields never span lines (splittable)")
    return p


def main(argv: list[str] | None = None) -> int:
    args, _unknown = parser().parse_known_args(argv)  # e.g. --JOB_NAME from the scheduler
    spark = SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from silverline.operators.gold import register_table
    from silverline.plans.categories import CategoryJobConfig, run_categories
    from silverline.plans.videos import VideoJobConfig, run_videos
    from silverline.streaming.incremental import stream_api_videos, stream_categories

    if args.job == "gold":
        from silverline.plans.gold import GoldJobConfig, refresh_gold, run_gold

        if not args.gold:
            raise SystemExit("the gold job needs --gold")
        regions = [code.strip() for code in args.regions.split(",") if code.strip()] or None
        if regions and args.refresh:
            raise SystemExit("--refresh finds its regions by itself; leave --regions out")
        job = refresh_gold if args.refresh else run_gold
        result = job(spark, GoldJobConfig(args.silver, args.gold, regions=regions))
    elif args.job in ("videos", "stream-videos"):
        cfg = VideoJobConfig(
            args.bronze,
            args.silver,
            source=args.source if args.job == "videos" else "youtube_api",
            kaggle_raw_prefix=args.kaggle_prefix,
            api_videos_prefix=args.api_prefix,
            silver_videos_prefix=args.silver_prefix,
            max_invalid_row_ratio=args.ratio,
            strict_dates=args.strict_dates,
            normalize_tags=args.normalize_tags,
            multi_line=not args.single_line_csv,
            write_quarantine=args.write_quarantine,
            api_multi_line=not args.single_line_api,
            write_drift=args.write_drift,
            partition_by=("source", "region", "trending_date") if args.partition_by_day else ("source", "region"),
        )
        result = run_videos(spark, cfg) if args.job == "videos" else stream_api_videos(spark, cfg)
        if args.catalog:
            register_table(spark, f"{args.catalog}.silver_videos", cfg.silver_path)
    else:
        cfg = CategoryJobConfig(
            args.bronze,
            args.silver,
            reference_prefix=args.ref_prefix.rstrip("/") + "/",
            api_categories_prefix=args.api_cat_prefix.rstrip("/") + "/",
            output_prefix=args.cat_out_prefix.rstrip("/") + "/",
        )
        result = run_categories(spark, cfg) if args.job == "categories" else stream_categories(spark, cfg)
        if args.catalog:
            register_table(spark, f"{args.catalog}.silver_categories", cfg.output_path)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
