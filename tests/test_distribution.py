import datetime as dt
import math
import random

from pyspark.sql import functions as F

from silverline.operators.distribution import GRID, K, distribution_drift, merge_sketches, metric_sketches, quantiles

SCHEMA = "source string, region string, trending_date date, view_count long"
DAY = [dt.date(2024, 1, d) for d in range(1, 10)]


def test_ranks_of_a_large_group_are_near_and_parts_merge(spark):
    rnd = random.Random(3)
    values = [int(rnd.paretovariate(1.1) * 100) for _ in range(40_000)]
    rows = [("api", "US", DAY[i % 4], v) for i, v in enumerate(values)]
    days = metric_sketches(spark.createDataFrame(rows, SCHEMA))
    whole = quantiles(merge_sketches(days, ["source", "region"])).first()
    assert whole["values"] == len(values)
    assert (whole["lowest"], whole["highest"]) == (min(values), max(values))
    for name, rank in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p99", 0.99)):
        below = sum(v < whole[name] for v in values) / len(values)
        upto = sum(v <= whole[name] for v in values) / len(values)
        assert below - 20 / K <= rank <= upto + 20 / K


def test_small_groups_are_exact(spark):
    values = [5, 1, 1, 9, 7, 3, 2, 8, 8, 4]
    df = spark.createDataFrame([("api", "US", DAY[0], v) for v in [*values, None]], SCHEMA)
    row = quantiles(metric_sketches(df)).first()
    ordered = sorted(values)
    assert (row["values"], row["nulls"]) == (10, 1)
    assert [row[n] for n in ("p25", "p50", "p75", "p90", "p99")] == [
        ordered[math.ceil(r * 10) - 1] for r in (0.25, 0.5, 0.75, 0.9, 0.99)
    ]


def test_drift_skips_days_without_values(spark):
    rows = [("api", "US", DAY[0], v) for v in range(100)]
    rows += [("api", "US", DAY[1], None)]
    rows += [("api", "US", DAY[2], v + 10) for v in range(100)]
    rows += [("api", "US", DAY[3], v + 10) for v in range(100)]
    got = distribution_drift(metric_sketches(spark.createDataFrame(rows, SCHEMA))).orderBy("trending_date").collect()
    assert [(r.previous_day, r.shift) for r in got] == [
        (None, None), (DAY[0], None), (DAY[0], 10.0), (DAY[2], 0.0)
    ]
    assert got[1].p50 is None and got[1].nulls == 1
    assert GRID == 16


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert distribution_drift(metric_sketches(empty)).collect() == []
    assert metric_sketches(empty.withColumn("view_count", F.lit(None).cast("long"))).count() == 0
