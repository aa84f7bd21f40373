"""GLD6: how a metric is distributed per source, region and day, by mergeable quantile sketches.

A sketch holds all values of a group of up to ``K`` rows, so its quantiles are exact there, and has a
bounded size with a rank error of about 1 / ``K`` beyond. Sketches of parts merge into the sketch of
the whole, so days are added without their rows being read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 4096
GRID = 16
RANKS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}


def metric_sketches(
    videos: DataFrame,
    metric: str = "view_count",
    by: Sequence[str] = ("source", "region", "trending_date"),
    k: int = K,
) -> DataFrame:
    """``by``, values, nulls, lowest, highest, sketch: one row per group, nulls only counted."""
    value = F.col(metric).cast("long")
    return videos.groupBy(*by).agg(
        F.count(value).alias("values"),
        F.count_if(value.isNull()).alias("nulls"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.kll_sketch_agg_bigint(value, k).alias("sketch"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of parts as sketches of coarser groups."""
    return sketches.groupBy(*by).agg(
        F.sum("values").alias("values"),
        F.sum("nulls").alias("nulls"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"),
    )


def _quantile(rank: Column) -> Column:
    return F.when(F.col("values") > 0, F.kll_sketch_get_quantile_bigint("sketch", rank))


def quantiles(sketches: DataFrame) -> DataFrame:
    """The sketch replaced by ``RANKS``; null where a group has no value."""
    named = {name: _quantile(F.lit(rank)) for name, rank in RANKS.items()}
    return sketches.withColumns(named).drop("sketch")


def distribution_drift(
    sketches: DataFrame, series: Sequence[str] = ("source", "region"), day: str = "trending_date"
) -> DataFrame:
    """``quantiles`` with ``previous_day`` and ``shift`` per day of a series.

    ``shift`` is the mean distance of the ``GRID`` equally spaced quantiles from those of the series' day
    before (the last one with a value): how far values moved, in the metric's unit. Null on the first day
    and where there is no value. A window reads one short row per day, never the sketches' rows.
    """
    grid = _quantile(F.array(*[F.lit(i / GRID) for i in range(1, GRID + 1)]))
    reduced = quantiles(sketches.withColumn("grid", grid))
    last = F.last(F.when(F.col("values") > 0, F.struct(F.col(day).alias("day"), "grid")), ignorenulls=True)
    before = last.over(Window.partitionBy(*series).orderBy(day).rowsBetween(Window.unboundedPreceding, -1))
    steps = F.zip_with("grid", "before.grid", lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    shift = F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x) / GRID
    return reduced.withColumn("before", before).select(
        *[c for c in reduced.columns if c != "grid"], F.col("before.day").alias("previous_day"), shift.alias("shift")
    )
