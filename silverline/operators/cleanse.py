"""Cleansing (CLN1-CLN4, PRJ6): one projection, no per-column loop of plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.contracts import BLANK_TO_NULL_COLUMNS, TEXT_COLUMNS
from silverline.functions.columns import blank_to_null


def cleanse_expressions(
    columns: Sequence[str],
    text_columns: Sequence[str] = TEXT_COLUMNS,
    blank_columns: Sequence[str] = BLANK_TO_NULL_COLUMNS,
    source_column: str = "source",
    region_column: str = "region",
    string_columns: Sequence[str] | None = None,
) -> dict[str, Column]:
    """The rewrite of every present column, composed in the reference order.

    ``source`` is lower-cased and ``region`` upper-cased after ``trim``; text
    columns are trimmed (spaces only); then an empty value becomes NULL for the
    critical columns, ``title`` and ``channel_title``. Absent columns are
    skipped (PRJ6). A date, number or timestamp rendered as text is never
    empty, so when ``string_columns`` is known the blank test runs only on
    those (no per-row cast of dates to text).
    """
    present = set(columns)
    strings = set(columns if string_columns is None else string_columns)
    exprs: dict[str, Column] = {}
    for name in columns:
        expr = F.col(name)
        changed = False
        if name == source_column:
            expr, changed = F.lower(F.trim(expr)), True
        elif name == region_column:
            expr, changed = F.upper(F.trim(expr)), True
        if name in text_columns:
            expr, changed = F.trim(expr), True
        if name in blank_columns and name in strings:
            expr, changed = blank_to_null(expr), True
        if changed and name in present:
            exprs[name] = expr
    return exprs


def cleanse_videos(
    df: DataFrame,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    blank_columns: Sequence[str] = BLANK_TO_NULL_COLUMNS,
    checked_at_column: str | None = "silver_quality_checked_at",
) -> DataFrame:
    """Normalise text and blanks in one ``withColumns`` and stamp the check time."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.withColumns(
        cleanse_expressions(df.columns, text_columns, blank_columns, string_columns=strings)
    )
    if checked_at_column:
        out = out.withColumn(checked_at_column, F.current_timestamp())
    return out
