"""What round 4 changed for time, disk and memory: nothing large is kept between steps, folders move in branches."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import DataFrame

from silverline import session
from silverline.operators.drift import variant_items, with_drift
from silverline.operators.ingest import land_payloads
from silverline.plans import ingestion, queries, standins
from silverline.plans.ingestion import IngestionConfig, run_ingestion
from silverline.plans.videos import VideoJobConfig, run_videos
from silverline.session import LISTING, apply_defaults, scratch_path, settings, staged
from silverline.sinks import folders
from silverline.sinks.folders import rename_all, replace_partitions
from silverline.sinks.silver import write_silver_categories
from silverline.streaming import latest
from silverline.streaming.incremental import stream_api_videos
from tests.fixtures import api_item, write_api_drop

RUN_TS = dt.datetime(2024, 1, 2, 3, tzinfo=dt.UTC)
PAYLOADS = "region string, dataset string, payload string"
ATTEMPTS = f"{PAYLOADS}, error_type string, message string"
VIDEOS, CATEGORIES = "trending_videos", "video_categories"


def test_landing_keeps_no_texts(spark, tmp_path, monkeypatch):
    """The payloads of both datasets used to be cached, as plain text, for the two writes."""
    rows = [("us", VIDEOS, '{"items": [1]}'), ("gb", VIDEOS, '{"items": []}'), ("us", CATEGORIES, '{"items": [2]}')]
    df = spark.createDataFrame(rows, PAYLOADS)
    monkeypatch.setattr(DataFrame, "persist", lambda *a, **k: (_ for _ in ()).throw(AssertionError("cached")))
    assert land_payloads(df, str(tmp_path), RUN_TS, "r") == {VIDEOS: 2, CATEGORIES: 1}


def test_a_frame_of_one_dataset_lands_with_a_count_of_none(spark, tmp_path):
    df = spark.createDataFrame([("us", VIDEOS, "{}")], PAYLOADS).filter("dataset = 'trending_videos'")
    assert land_payloads(df, str(tmp_path), RUN_TS, "r") == {VIDEOS: 1, CATEGORIES: 0}


def test_ingestion_checkpoints_no_texts(spark, tmp_path, monkeypatch):
    """Attempts and payloads used to be written out twice as plain rows."""
    seen = []
    kept = ingestion.materialize
    monkeypatch.setattr(ingestion, "materialize", lambda df: seen.append(df.columns) or kept(df))
    rows = [("us", VIDEOS, '{"items": [1, 2]}', None, None), ("gb", VIDEOS, None, "TimeoutError", "no answer")]
    rows += [("us", CATEGORIES, '{"items": [3]}', None, None)] * 2
    cfg = IngestionConfig(str(tmp_path / "bronze"), str(tmp_path / "reports"))
    result = run_ingestion(spark, spark.createDataFrame(rows, ATTEMPTS), cfg, RUN_TS, "r1")
    assert result == {"run_id": "r1", "status_code": 207, "payloads": {VIDEOS: 1, CATEGORIES: 1}}
    assert seen and not any("payload" in columns for columns in seen)
    listed = spark.read.parquet(cfg.report_path("payload_manifest"))
    assert {(r["dataset"], r["item_count"]) for r in listed.collect()} == {(VIDEOS, 2), (CATEGORIES, 1)}


def test_only_partitions_with_new_rows_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(*rows):
        replace_partitions(spark.createDataFrame(rows, "a string, b string, v int"), path, ("a", "b"))

    put(("x", "1", 1), ("x", "2", 2))
    put(("x", "2", 20), ("x", "3", 3), ("y", "1", 4))
    found = {(r["a"], str(r["b"]), r["v"]) for r in spark.read.parquet(path).collect()}
    assert found == {("x", "1", 1), ("x", "2", 20), ("x", "3", 3), ("y", "1", 4)}
    assert sorted(p.name for p in tmp_path.glob("t/*")) == ["a=x", "a=y"]  # nothing is left beside them


def test_staged_rows_and_settings_go_after_their_block(spark, tmp_path):
    name, before = "spark.sql.maxConcurrentOutputFileWriters", None
    before = spark.conf.get(name, None)
    with settings(spark, {name: "7"}):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name, None) == before
    df = spark.range(5).selectExpr("id", "cast(id as string) as text")
    with staged(df, "test") as rows:
        files = rows.inputFiles()
        assert rows.schema.names == ["id", "text"] and rows.count() == 5
    fs = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert files and not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
    assert scratch_path(spark, "test") != scratch_path(spark, "test")


def test_a_winner_keeps_its_rank_once_and_its_whole_bronze_key(spark):
    """State used to hold publish time and Bronze key in the row and again in its rank."""
    columns = "source string, region string, video_id string, trending_date string, published_at timestamp, title string, bronze_key string"
    key = ("youtube_api", "us", "v", "2024-01-02")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [
        (*key, t2, "early", "file:/b/region=us/date=2024-01-02/hour=03/a"),
        (*key, t2, "late", "file:/a/region=us/date=2024-01-02/hour=09/a"),
        (*key, t1, "older", "file:/b/region=us/date=2024-01-02/hour=20/a"),
        ("youtube_api", "us", "w", None, None, None, "elsewhere/a"),
        ("youtube_api", "us", "x", None, None, "no file", None),
    ]
    best = latest.winners(spark.createDataFrame(rows, columns))
    assert "max_by" not in best._jdf.queryExecution().optimizedPlan().toString()
    found = {r["video_id"]: (r["title"], r["bronze_key"]) for r in best.collect()}
    assert found == {"v": ("late", rows[1][-1]), "w": (None, "elsewhere/a"), "x": ("no file", None)}
    assert sorted(best.columns) == sorted(columns.split(" ")[::2])


def test_a_batch_of_changes_goes_straight_to_its_folder(spark, tmp_path, monkeypatch):
    """It used to be shuffled and sorted by two columns that are the same in every row."""
    cfg = VideoJobConfig(str(tmp_path / "bronze"), str(tmp_path / "silver"), source="youtube_api")
    write_api_drop(tmp_path / "bronze", "us", "2024-01-02", "09", "r1", [api_item(i, "us") for i in range(5)])
    partitioned = []
    used = type(spark.range(1).write).partitionBy
    monkeypatch.setattr(type(spark.range(1).write), "partitionBy", lambda *a: partitioned.append(a) or used(*a))
    assert latest.stream_latest_videos(spark, cfg, checkpoint=str(tmp_path / "c")) == [{"batch_id": 0, "changed_keys": 5}]
    latest.compact_changes(spark, cfg)
    assert not partitioned
    folders = [str(p.relative_to(latest.changes_path(cfg))) for p in (tmp_path / "silver").glob("_changes/videos/*/*")]
    assert folders == ["stream_id=compacted/batch_id=0"]


def test_a_stream_batch_is_not_cached_and_leaves_no_stage(spark, tmp_path, monkeypatch):
    """A batch's parsed rows used to be cached by the executors, in memory and as plain rows on their disks."""
    cfg = VideoJobConfig(str(tmp_path / "bronze"), str(tmp_path / "silver"), source="youtube_api")
    write_api_drop(tmp_path / "bronze", "us", "2024-01-02", "09", "r1", [api_item(i, "us") for i in range(5)])
    made, kept = [], session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda *a: made.append(kept(*a)) or made[-1])
    monkeypatch.setattr(DataFrame, "persist", lambda *a, **k: (_ for _ in ()).throw(AssertionError("cached")))
    records = stream_api_videos(spark, cfg, checkpoint=str(tmp_path / "c"))
    assert [(r["input_rows"], r["output_rows"]) for r in records] == [(5, 5)]
    assert spark.read.parquet(cfg.silver_path).count() == 5
    assert len(made) == 1 and not Path(made[0].removeprefix("file:")).exists()


def drift_of(spark, item):
    doc = json.dumps({"items": [item]})
    raw = spark.createDataFrame([(doc,)], "value string").selectExpr("value", "named_struct('file_path', 'f') as _metadata")
    rows = with_drift(variant_items(raw)).selectExpr("transform(drift, x -> concat(x.path, ' ', x.status)) as d").collect()
    return sorted(rows[0]["d"])


def test_kinds_are_told_apart_without_patterns(spark):
    """Every field used to be held against a regular expression, objects by a text of all that is in them."""
    assert drift_of(spark, {"id": "a", "snippet": {}, "statistics": None, "contentDetails": {"caption": None}}) == []
    assert drift_of(spark, {"id": 1, "snippet": [], "statistics": "x"}) == [
        "id retyped", "snippet retyped", "statistics retyped",
    ]
    assert drift_of(spark, {"snippet": {"tags": []}, "odd": None, "etag": 1}) == ["odd unknown"]
    assert drift_of(spark, {"snippet": {"tags": [None]}}) == []
    assert drift_of(spark, {"snippet": {"tags": ["a", 1], "more": {"b": 1}}}) == ["snippet.more unknown", "snippet.tags retyped"]
    raw = spark.createDataFrame([("{}",)], "value string").selectExpr("value", "named_struct('file_path', 'f') as _metadata")
    plan = with_drift(variant_items(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "regexp" not in plan


def test_drift_is_not_cached(spark, tmp_path, monkeypatch):
    """Keys, paths and values of every item used to be cached for the report and the rescued values."""
    cfg = VideoJobConfig(str(tmp_path / "bronze"), str(tmp_path / "silver"), source="youtube_api", write_drift=True)
    write_api_drop(tmp_path / "bronze", "us", "2024-01-02", "09", "r1", [{**api_item(i, "us"), "extra": i} for i in range(5)])
    monkeypatch.setattr(DataFrame, "persist", lambda *a, **k: (_ for _ in ()).throw(AssertionError("cached")))
    run_videos(spark, cfg)
    assert spark.read.parquet(cfg.drift_path).first()["items"] == 5
    assert spark.read.parquet(cfg.rescued_path).count() == 5


def test_bronze_rows_are_no_plain_checkpoint(spark, monkeypatch):
    kept = DataFrame.checkpoint

    def checkpoint(df, *a, **k):
        assert "video_id" not in df.columns
        return kept(df, *a, **k)

    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    orders = spark.createDataFrame([(1, "F", "1-URGENT", dt.datetime(2024, 1, 2))], "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame(
        [(1, n, 10, 20, dt.datetime(2024, 1, 3), "R", "O", 2.0) for n in range(3)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string, l_quantity double",
    )
    monkeypatch.setattr(queries, "table", lambda _, __, name: {"orders": orders, "lineitem": lines}[name])
    rows = queries.api_bronze_videos(spark, "").collect()
    assert sorted(r["video_id"] for r in rows) == ["1-0", "1-1", "1-2"]
    assert {(r["region"], r["trending_date"], r["view_count"], r["tags"]) for r in rows} == {("UR", "2024-01-02", 2, "R|O")}


def test_dropped_files_are_dealt_over_the_tasks(spark, tmp_path, monkeypatch):
    """A frame of one partition used to write all its files, some 50 items each, in one task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.createDataFrame([("us", f"f{i}", str(i)) for i in range(10 * n)], "region string, file string, value string").coalesce(1)
    parts = []
    monkeypatch.setattr(standins, "rename_all", lambda s, pairs: parts.extend(pairs) or rename_all(s, pairs))
    standins.write_category_drop(files, str(tmp_path), "d1")
    assert len({old.rsplit("/", 1)[1].split("-")[1] for old, _ in parts}) > 1
    assert {f.name: f.read_text().rstrip("\x1e") for f in tmp_path.glob("d1/region=us/*.json")} == {
        f"f{i}.json": str(i) for i in range(10 * n)
    }


def test_folders_are_listed_by_few_tasks(spark):
    """A listing used to run a task for every folder."""
    apply_defaults(spark)
    assert int(spark.conf.get(LISTING)) <= 200


def test_category_folders_move_and_others_stay(spark, tmp_path, monkeypatch):
    """One folder a file: the driver used to move every file and every folder by itself."""
    path, moved = str(tmp_path / "c"), []
    monkeypatch.setattr(folders, "_rename", lambda fs, hpath, *pair: moved.append(pair) or fs.rename(*map(hpath, pair)))

    def put(names, v):
        rows = [("kaggle", "us", name, v) for name in names]
        write_silver_categories(spark.createDataFrame(rows, "source string, region string, bronze_file string, v int"), path)

    put([f"f{i}" for i in range(20)], 1)
    assert len(moved) == 1  # the whole branch
    put(["f3", "new"], 2)
    found = {r["bronze_file"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert found == {f"f{i}": 2 if i == 3 else 1 for i in range(20)} | {"new": 2}
