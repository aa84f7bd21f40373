"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a plain Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable is evaluated before the lambda body, so an expensive
    expression bound here is not repeated for each element of an inner lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], text: int, rows: int = 1000, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows and, but for a single longer text in
    column ``text``, ``size`` bytes of text: what Python objects are made of at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(batch):
            before = ends[lo - 1] if lo else 0
            hi = min(max(int(np.searchsorted(ends, before + size, side="right")), lo + 1), lo + rows, len(batch))
            yield batch.slice(lo, hi - lo)
            lo = hi


def with_results(df: DataFrame, keep: list[str], text: str, fields: list[T.StructField], setup: Callable) -> DataFrame:
    """``keep`` columns as they are, and ``fields`` computed in Python from the other columns.

    ``setup()`` gives, once per task, a function from a pandas frame of the others to a
    dict of lists. Kept columns stay in Arrow: pandas would turn whole numbers beside a
    null into doubles. Batches are cut by ``slices`` on the column ``text``.
    """
    others = [c for c in df.columns if c not in keep or c == text]
    names = [*keep, *[c for c in others if c not in keep]]
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def run(batches):
        step = setup()
        for batch in slices(batches, names.index(text)):
            table = pa.Table.from_batches([batch])
            out = step(table.select(others).to_pandas())
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(out[n], t) for n, t in kinds]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *(n for n, _ in kinds)])

    return df.select(*names).mapInArrow(run, T.StructType([*(df.schema[c] for c in keep), *fields]))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _file_system(spark, path)
    return fs.exists(hpath)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Drop a staged folder whose last reader is done."""
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def _file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath  # noqa: SLF001
