"""GLD7: catalog tables that help plans: buckets, column statistics, touched partitions.

Tables bucketed by the same keys into as many buckets join and aggregate by these keys without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

STATEMENT_PARTITIONS = 200  # partitions registered by one statement


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """``df`` as table ``name`` at ``path``: a file per bucket, sorted by ``keys``, with statistics of these."""
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .mode("overwrite")
        .option("path", path)
        .format("parquet")
        .saveAsTable(name)
    )
    columns = ", ".join(f"`{k}`" for k in keys)
    df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {columns}")


def _literal(value: object) -> str:
    if value is None:
        raise ValueError("a partition needs a value for each of its columns")
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_partitions(spark: SparkSession, name: str, partitions: Iterable[Mapping[str, object]]) -> int:
    """Registers the partitions that a run wrote, and lists no other folder; how many were given."""
    specs = [
        "PARTITION (" + ", ".join(f"`{k}` = {_literal(v)}" for k, v in p.items()) + ")" for p in partitions
    ]
    for start in range(0, len(specs), STATEMENT_PARTITIONS):
        some = " ".join(specs[start : start + STATEMENT_PARTITIONS])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {some}")
    return len(specs)
