import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverline.contracts import PROJECTED_VIDEO_COLUMNS, VIDEO_TYPES
from silverline.operators.cleanse import cleanse_videos
from silverline.operators.dedup import dedup_videos
from silverline.operators.quality import (
    QualityGateError,
    collect_quality_metrics,
    enforce_gate,
    gate_verdict,
    quality_metrics,
    run_record,
)


def videos(spark, rows):
    """Rows as dicts over the 25-column contract (missing keys are NULL)."""
    schema = ", ".join(f"{c} {VIDEO_TYPES[c].simpleString()}" for c in PROJECTED_VIDEO_COLUMNS)
    data = [tuple(r.get(c) for c in PROJECTED_VIDEO_COLUMNS) for r in rows]
    return spark.createDataFrame(data, schema)


def valid(i, **kw):
    row = {
        "source": "kaggle",
        "region": "us",
        "video_id": f"v{i}",
        "trending_date": dt.date(2024, 1, 1),
        "published_at": dt.datetime(2024, 1, 1, 0, 0, i % 60),
        "category_id": 1,
        "title": "t",
        "channel_title": "c",
        "view_count": 1,
    }
    row.update(kw)
    return row


def gate(spark, rows, limit=0.05):
    m = collect_quality_metrics(cleanse_videos(videos(spark, rows)), "test")
    enforce_gate(m, limit)
    return m


def test_ratio_exactly_at_limit_passes(spark):
    rows = [valid(i) for i in range(19)] + [valid(99, video_id="")]
    m = gate(spark, rows)
    assert m["invalid_critical_row_ratio"] == 0.05


def test_ratio_just_above_limit_fails(spark):
    rows = [valid(i) for i in range(18)] + [valid(98, video_id=" "), valid(99, category_id=None)]
    with pytest.raises(QualityGateError, match="the limit is"):
        gate(spark, rows)


def test_all_invalid_with_limit_one_fails_no_valid_rows(spark):
    rows = [valid(i, region="  ") for i in range(3)]
    with pytest.raises(QualityGateError, match="no row passes"):
        gate(spark, rows, limit=1.0)


def test_zero_rows_fails(spark):
    with pytest.raises(QualityGateError, match="has no rows"):
        gate(spark, [])


def test_negative_metric_on_invalid_row_still_fails(spark):
    rows = [valid(i) for i in range(40)] + [valid(99, video_id=None, like_count=-1)]
    with pytest.raises(QualityGateError, match="below zero"):
        gate(spark, rows)


def test_limit_out_of_range():
    with pytest.raises(ValueError):
        enforce_gate({"dataset": "x", "input_rows": 1}, 1.5)


def test_metrics_and_verdict_expression(spark):
    rows = [valid(i) for i in range(9)] + [valid(9, title="", trending_date=None)]
    df = cleanse_videos(videos(spark, rows))
    m = quality_metrics(df).withColumn("verdict", gate_verdict()).first()
    assert (m.input_rows, m.invalid_critical_rows, m.missing_title, m.verdict) == (10, 1, 1, "invalid_ratio")


def test_cleanse_trims_spaces_not_tabs_and_blanks_to_null(spark):
    df = cleanse_videos(
        videos(spark, [valid(1, source=" KAGGLE ", region=" us ", title="  ", channel_title="\tx\t", description=" d ")])
    )
    r = df.first()
    assert (r.source, r.region, r.title, r.channel_title, r.description) == ("kaggle", "US", None, "\tx\t", "d")
    assert r.silver_quality_checked_at is not None


def test_dedup_prefers_later_publish_then_later_file(spark):
    t = dt.datetime(2024, 1, 1, 12)
    rows = [
        valid(1, published_at=t, title="early file"),
        valid(1, published_at=t, title="late file"),
        valid(1, published_at=t - dt.timedelta(hours=1), title="older"),
        valid(2, published_at=None, title="null time"),
        valid(2, published_at=t, title="has time"),
    ]
    df = videos(spark, rows).withColumn(
        "_source_file",
        F.when(F.col("title") == "late file", F.lit("hour=05/x.json")).otherwise(F.lit("hour=03/x.json")),
    )
    out = {r.video_id: r.title for r in dedup_videos(df).collect()}
    assert out == {"v1": "late file", "v2": "has time"}


def test_dedup_exact_copies_and_idempotence(spark):
    rows = [valid(1), valid(1), valid(2)]
    once = dedup_videos(videos(spark, rows))
    twice = dedup_videos(once)
    assert once.count() == 2
    assert sorted(once.drop("silver_ingestion_timestamp").collect()) == sorted(
        twice.drop("silver_ingestion_timestamp").collect()
    )


def test_run_record_balances():
    checks = {"dataset": "d", "input_rows": 10, "invalid_critical_rows": 2}
    rec = run_record(checks, output_rows=5)
    assert rec["input_rows"] == rec["invalid_rows_removed"] + rec["duplicate_rows_removed"] + rec["output_rows"]
