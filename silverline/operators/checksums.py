"""GLD4: two tables compared by checksums, rows only where these differ.

``write_checked`` lays a table out by a hash of its keys (a folder per bucket, cells sorted
within) and writes checksums per bucket and per cell beside it. The checksums are sums of row hashes and
counts, so neither the order of rows nor the number of files matters.
``checked_differences`` reads the bucket checksums first, the cell checksums of the buckets that differ
next, and rows of the cells that differ last: what it reads of the tables follows the differences.

Rows are compared as multisets, null equal to null; keys may repeat. Two different cells
with equal count and both 32-bit sums would be taken for equal (some 2^-64 per cell).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
CELLS = 4096
BUCKET, CELL = "checked_bucket", "checked_cell"
SUMS = ("n", "low", "high")


def _hash(columns: Sequence[str]) -> Column:
    """Hash of the values and of which are null (nulls alone leave a hash as it is)."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def write_checked(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, cells: int = CELLS) -> None:
    """Rows at ``path``/rows, checksums at ``path``/checksums; an earlier table there is replaced."""
    columns = df.columns
    taken = {BUCKET, CELL} & set(columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are this layout's own")
    place = F.pmod(_hash(keys), F.lit(buckets * cells))
    placed = df.select(
        *columns, F.floor(place / cells).cast("int").alias(BUCKET), F.pmod(place, F.lit(cells)).cast("int").alias(CELL)
    )
    # A rebalance deals small buckets to one task and splits large ones.
    placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, CELL).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(BUCKET).parquet(f"{path}/rows")
    row = _hash(columns)
    written = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    by_cell = (
        written.select(BUCKET, CELL, row.alias("h"))
        .groupBy(BUCKET, CELL)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
            F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
        )
    )
    layout = {"buckets": F.lit(buckets), "cells": F.lit(cells)}
    by_cell.repartitionByRange(BUCKET, CELL).sortWithinPartitions(BUCKET, CELL).withColumns(layout).write.mode(
        "overwrite"
    ).parquet(f"{path}/checksums/by_cell")
    stored = df.sparkSession.read.parquet(f"{path}/checksums/by_cell")
    # At most ``cells`` sums of a bucket: decimals hold them whole.
    totals = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in SUMS]
    stored.groupBy(BUCKET, "buckets", "cells").agg(*totals).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/checksums/by_bucket"
    )


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose sums differ, those of one side only among them."""
    signed = left.select(*by, *SUMS).unionByName(right.select(*by, *[(-F.col(c)).alias(c) for c in SUMS]))
    differs = " OR ".join(f"{c} <> 0" for c in SUMS)
    return signed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS]).where(differs).select(*by)


def checked_cells(spark: SparkSession, left_path: str, right_path: str) -> tuple[list[int], DataFrame]:
    """Buckets that differ (at most as many as the layout has) and their differing (bucket, cell)."""
    coarse = [spark.read.parquet(f"{p}/checksums/by_bucket") for p in (left_path, right_path)]
    layouts = coarse[0].unionByName(coarse[1]).select("buckets", "cells").distinct().collect()
    if len(layouts) > 1:
        raise ValueError(f"the tables are laid out differently: {[tuple(x) for x in layouts]}")
    found = sorted(r[0] for r in _differing(*coarse, [BUCKET]).collect())
    fine = [spark.read.parquet(f"{p}/checksums/by_cell").where(F.col(BUCKET).isin(found)) for p in (left_path, right_path)]
    return found, _differing(*fine, [BUCKET, CELL])


def checked_differences(spark: SparkSession, left_path: str, right_path: str) -> DataFrame:
    """Rows that do not stand equally often on both sides, with ``left_rows`` and ``right_rows``."""
    found, cells = checked_cells(spark, left_path, right_path)
    # The folder of a table without rows holds no schema.
    schema = next(
        (s for s in (_rows_schema(spark, p) for p in (left_path, right_path)) if s is not None), None
    )
    if schema is None:
        raise ValueError("both tables are empty")
    sides = []
    for path, counts in ((left_path, (1, 0)), (right_path, (0, 1))):
        rows = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col(BUCKET).isin(found))
        sides.append(
            rows.join(cells, [BUCKET, CELL], "left_semi")
            .drop(BUCKET, CELL)
            .withColumns({"left_rows": F.lit(counts[0]).cast("long"), "right_rows": F.lit(counts[1]).cast("long")})
        )
    columns = [c for c in sides[0].columns if c not in ("left_rows", "right_rows")]
    both = sides[0].unionByName(sides[1]).groupBy(*columns)
    return both.agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")).where(
        "left_rows <> right_rows"
    )


def _rows_schema(spark: SparkSession, path: str):
    """Schema of the rows, partition column included; None for a table without files."""
    if spark.read.parquet(f"{path}/checksums/by_bucket").isEmpty():
        return None
    return spark.read.parquet(f"{path}/rows").schema
