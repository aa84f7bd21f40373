"""D9/GLD3: the category title that was valid on the trending day.

Drops of category files give each id validity intervals; a day takes the version that was the last
to come on or before it. Days and versions are unioned and sorted per id, so there is no range
join, and only distinct days of an id meet its versions, never its videos.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.operators.dedup import current_version

CATEGORY_KEYS = ("source", "region", "category_id")


def _normal(df: DataFrame) -> DataFrame:
    """The two Silver tables write regions and type ids differently."""
    normal = {"region": F.upper("region"), "category_id": F.col("category_id").cast("bigint")}
    return df.withColumns({c: e for c, e in normal.items() if c in df.columns})


def category_validity(
    categories: DataFrame, keys: Sequence[str] = CATEGORY_KEYS, dropped: str = "drop_date", version: str = "bronze_file"
) -> DataFrame:
    """``keys``, category_title, valid_from, valid_to: an interval per drop day, open (null) for the last.

    Of several drops of a day the last file counts; a drop without a date is left out.
    """
    dated = _normal(categories).where(F.col(dropped).isNotNull())
    rows = current_version(dated, [*keys, dropped], version)
    following = F.lead(dropped).over(Window.partitionBy(*keys).orderBy(dropped))
    return rows.select(*keys, "category_title", F.col(dropped).alias("valid_from"), following.alias("valid_to"))


def valid_on(days: DataFrame, validity: DataFrame, keys: Sequence[str], day: str = "trending_date") -> DataFrame:
    """Each distinct (``keys``, day) with the title and interval valid then; nulls before the first drop."""
    version = F.struct("category_title", "valid_from", "valid_to")
    events = (
        days.select(*keys, F.col(day).alias("at"), F.lit(1).alias("asks"))
        .distinct()
        .withColumn("version", F.lit(None).cast(validity.select(version.alias("v")).schema["v"].dataType))
        .unionByName(validity.select(*keys, F.col("valid_from").alias("at"), F.lit(0).alias("asks"), version.alias("version")))
    )
    so_far = Window.partitionBy(*keys).orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("version", F.last("version", ignorenulls=True).over(so_far)).where("asks = 1")
    return found.select(*keys, F.col("at").alias(day), "version.*")


def category_analytics_as_of(
    videos: DataFrame,
    validity: DataFrame,
    group_keys: Sequence[str] = CATEGORY_KEYS,
    keys: Sequence[str] = CATEGORY_KEYS,
    day: str = "trending_date",
) -> DataFrame:
    """GLD3 by the title of the day: one row per group and version, with its first and last trending day.

    Videos are reduced to one row per group and day before anything is joined. Days before the
    first drop have no title.
    """
    per_day = _normal(videos).groupBy(*group_keys, day).agg(
        F.count(F.lit(1)).alias("videos"), F.sum("view_count").alias("views")
    )
    titled = per_day.join(valid_on(per_day, validity, keys, day), [*keys, day], "left")
    return titled.groupBy(*group_keys, "category_title", "valid_from", "valid_to").agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.sum("videos").alias("videos"),
        F.sum("views").alias("total_views"),
    )
