import pytest

from silverline.operators.bucketed import add_partitions, save_bucketed


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_tables_join_and_aggregate_without_a_shuffle(spark, tmp_path, no_broadcast):
    rows = spark.range(2000).selectExpr("CAST(id % 3 AS STRING) AS region", "CAST(id % 50 AS STRING) AS video_id", "id AS v")
    for name in ("left", "right"):
        save_bucketed(rows, f"bucketed_{name}", str(tmp_path / name), ["region", "video_id"], 4)
    left, right = (spark.table(f"bucketed_{n}").groupBy("region", "video_id").sum("v") for n in ("left", "right"))
    joined = left.join(right, ["region", "video_id"])
    assert joined.count() == rows.select("region", "video_id").distinct().count()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    stats = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED bucketed_left video_id").collect()}
    assert int(stats["distinct_count"]) > 0
    for name in ("left", "right"):
        spark.sql(f"DROP TABLE bucketed_{name}")


def test_only_touched_partitions_are_registered(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("kaggle", "US", 1), ("kaggle", "it's", 2), ("api", "GB", 4)]
    spark.createDataFrame(rows, "source string, region string, v int").write.partitionBy("source", "region").parquet(path)
    spark.sql("DROP TABLE IF EXISTS touched_t")
    spark.sql(
        f"CREATE TABLE touched_t (v int, source string, region string) USING parquet "
        f"PARTITIONED BY (source, region) LOCATION '{path}'"
    )
    touched = [{"source": "kaggle", "region": "US"}, {"source": "kaggle", "region": "it's"}]
    assert add_partitions(spark, "touched_t", touched) == 2
    assert add_partitions(spark, "touched_t", touched[:1]) == 1  # again: it is there
    assert add_partitions(spark, "touched_t", []) == 0
    assert spark.sql("SELECT sum(v) AS s FROM touched_t").first().s == 3
    with pytest.raises(ValueError, match="value"):
        add_partitions(spark, "touched_t", [{"source": "kaggle", "region": None}])
    spark.sql("DROP TABLE touched_t")
