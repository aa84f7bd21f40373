"""Dense rank inside a group without putting a whole group in one task.

``Window.partitionBy(group).orderBy(value)`` sends every row of a group to one
task; when one group (one region, say) holds a third of all rows, that task
does a third of the work. Here the distinct (group, value) pairs are range
partitioned on (group, value), so a large group spans many partitions. Each
partition numbers its rows locally; a small table of per-partition counts
(at most partitions + groups - 1 rows, because range partitions are contiguous)
turns the local numbers into group-wide ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverline.session import materialize


_ROW_BITS = 33  # monotonically_increasing_id: partition index << 33 | row index


def dense_rank_within(
    df: DataFrame,
    group: str,
    value: str,
    descending: bool = True,
    rank_column: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``rank_column``: the dense rank of ``value`` inside ``group``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    distinct_values = df.select(group, value).distinct()
    ordered = (
        distinct_values.repartitionByRange(n, F.col(group).asc_nulls_last(), order)
        .sortWithinPartitions(F.col(group).asc_nulls_last(), order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mid", _ROW_BITS))
        .withColumn("_idx", F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_mid")
    )
    # The numbered values feed two branches (per-partition counts and the
    # ranks). Range bounds come from sampling, so two independent runs of the
    # range shuffle could disagree; materialising once makes both branches
    # read the same numbering, whatever the plan reuses.
    ordered = materialize(ordered)
    # Rank of a value = values of its group in earlier partitions + its place
    # among its group's rows in its own partition.
    per_part = ordered.groupBy(group, "_part").agg(
        F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    offsets = per_part.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy(group)
                .orderBy("_part")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).drop("_n")
    # offsets has at most partitions + groups - 1 rows; no hint and no count
    # action here: AQE turns this into a broadcast from the runtime size.
    ranked_values = ordered.join(offsets, [group, "_part"], "inner").select(
        group,
        value,
        (F.col("_before") + F.col("_idx") - F.col("_first") + 1).alias(rank_column),
    )
    ranked_values = ranked_values.withColumnsRenamed({group: "_g", value: "_v"})
    cond = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return df.join(ranked_values, cond, "inner").select(*df.columns, rank_column)
