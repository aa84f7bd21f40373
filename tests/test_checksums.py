import pytest

from silverline.operators.checksums import BUCKET, CELL, checked_cells, checked_differences, write_checked

SCHEMA = "region string, video_id string, views long"
ROWS = [("us", f"v{i}", i % 7) for i in range(4000)] + [(None, None, None), ("us", "twice", 1), ("us", "twice", 1)]


def _written(spark, path, rows, buckets=16, cells=64):
    write_checked(spark.createDataFrame(rows, SCHEMA), str(path), ["region", "video_id"], buckets, cells)
    return str(path)


def _found(spark, left, right):
    return sorted((tuple(r) for r in checked_differences(spark, left, right).collect()), key=repr)


def test_same_rows_in_another_order_and_other_files_read_nothing(spark, tmp_path):
    left = _written(spark, tmp_path / "a", ROWS)
    write_checked(
        spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(5), str(tmp_path / "b"), ["region", "video_id"], 16, 64
    )
    found, cells = checked_cells(spark, left, str(tmp_path / "b"))
    assert found == [] and cells.isEmpty()
    assert _found(spark, left, str(tmp_path / "b")) == []


def test_differences_are_those_of_the_multisets(spark, tmp_path):
    left = _written(spark, tmp_path / "a", ROWS)
    changed = [r for r in ROWS if r[1] != "v5"] + [("us", "new", 3), ("us", "twice", 1)]
    changed = [("us", "v9", None) if r[1] == "v9" else r for r in changed]
    right = _written(spark, tmp_path / "b", changed)
    assert _found(spark, left, right) == sorted(
        [("us", "v5", 5, 1, 0), ("us", "new", 3, 0, 1), ("us", "twice", 1, 2, 3), ("us", "v9", 2, 1, 0), ("us", "v9", None, 0, 1)],
        key=repr,
    )
    found, cells = checked_cells(spark, left, right)
    # Four keys: at most as many buckets and cells, so rows read follow the differences.
    assert 1 <= len(found) <= 4 and 1 <= cells.count() <= 4
    read = spark.read.parquet(f"{left}/rows").join(cells, [BUCKET, CELL], "left_semi").count()
    assert read < len(ROWS) / 20
    plan = checked_differences(spark, left, right)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "checked_bucket" in plan


def test_where_nulls_stand_matters(spark, tmp_path):
    left = _written(spark, tmp_path / "a", [(None, "x", 1)])
    right = _written(spark, tmp_path / "b", [("x", None, 1)])
    assert len(_found(spark, left, right)) == 2


def test_empty_sides_and_other_layouts(spark, tmp_path):
    empty = _written(spark, tmp_path / "e", [])
    some = _written(spark, tmp_path / "s", [("us", "a", 1)])
    assert _found(spark, empty, some) == [("us", "a", 1, 0, 1)]
    assert _found(spark, some, empty) == [("us", "a", 1, 1, 0)]
    assert _found(spark, some, some) == []
    other = _written(spark, tmp_path / "o", [("us", "a", 1)], cells=32)
    with pytest.raises(ValueError, match="laid out differently"):
        checked_differences(spark, some, other)
    with pytest.raises(ValueError, match="own"):
        write_checked(spark.createDataFrame([(1,)], f"{BUCKET} int"), str(tmp_path / "c"), [BUCKET])
