"""Row filters and the counts that go with them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def is_filled(column: str, trim: bool = False) -> Column:
    """Neither null nor the empty string; with ``trim``, nor blank."""
    c = F.col(column)
    return c.isNotNull() & ((F.trim(c) if trim else c) != "")


def all_filled(columns: Sequence[str], trim: bool = False) -> Column:
    return reduce(Column.__and__, [is_filled(c, trim) for c in columns], F.lit(True))


def filter_null_or_empty(df: DataFrame, columns: Sequence[str], trim: bool = False) -> DataFrame:
    """Rows whose columns are all filled."""
    return df.filter(all_filled(columns, trim))


def _filter_counts(keep: Column) -> list[Column]:
    kept = F.count_if(keep)
    total = F.count(F.lit(1))
    return [
        total.alias("in_rows"),
        (total - kept).alias("dropped_rows"),
        kept.alias("kept_rows"),
    ]


def load_and_filter(
    table: DataFrame | str,
    response_col: str = "title",
    text_col: str = "text",
    observation: Observation | None = None,
) -> DataFrame:
    """Rows of a table (or its name) with text and response. ``observation``
    receives ``in_rows``, ``dropped_rows`` and ``kept_rows`` from the first full
    action that uses the result, so that no job of its own counts them."""
    df = SparkSession.active().read.table(table) if isinstance(table, str) else table
    keep = all_filled([text_col, response_col])
    if observation is not None:
        df = df.observe(observation, *_filter_counts(keep))
    return df.filter(keep)


def filter_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows read, dropped and kept by ``filter_null_or_empty``."""
    return df.agg(*_filter_counts(all_filled(columns)))


def documented_functions(df: DataFrame) -> DataFrame:
    """Functions (no classes or methods) with arguments and a numpy style docstring."""
    return df.filter(
        F.col("doc_string").isNotNull()
        & (F.col("element_type") == "function")
        & F.col("args").isNotNull()
        & (F.length("args") > 0)
        & F.col("doc_string").contains("Parameters")
    )
