"""One row per key: exact deduplication and the latest row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.strings import content_digest
from corpusprep.operators.ordering import column, names


def _one_row(
    df: DataFrame,
    keys: Sequence[Column],
    order: Sequence[str],
    pick: Callable[[str], Column],
    pick_by: Callable[[str, str], Column],
) -> DataFrame:
    """The row of each key whose ``order`` columns ``pick`` chooses. A narrow pass
    finds it from keys and order alone, aggregating before the shuffle, so a key held
    by a third of all rows sends one row per task. The rows themselves are shuffled
    once, and hashed against what was found, not sorted. Order columns that do not
    tell a key's chosen row from another stop the job."""
    by = [f"_k{i}" for i in range(len(keys))]
    mine = column(order[0]) if len(order) == 1 else F.struct(*[column(c).alias(f"_o{i}") for i, c in enumerate(order)])
    narrow = df.select(*[k.alias(name) for k, name in zip(keys, by)], mine.alias("_place"))
    # Equal places first, so that a place held twice is seen when it is chosen. Null is
    # chosen only if there is nothing else.
    counted = narrow.groupBy(*by, "_place").agg(F.count(F.lit(1)).alias("_n"))
    found = counted.groupBy(*by).agg(pick("_place").alias("_best"), F.coalesce(pick_by("_n", "_place"), F.max("_n")).alias("_n"))
    stop = F.raise_error(F.lit(f"{list(order)} do not tell the rows of a key apart")).cast("bigint")
    chosen = found.select(*by, "_best", F.when(F.col("_n") > 1, stop).otherwise(F.col("_n")).alias("_once"))
    same = [mine.eqNullSafe(F.col("_best")), *[k.eqNullSafe(F.col(name)) for k, name in zip(keys, by)], F.col("_once") == 1]
    return df.join(chosen.hint("shuffle_hash"), reduce(Column.__and__, same), "left_semi")


def dedup_exact(df: DataFrame, subset: Sequence[str], keep_by: str | Sequence[str]) -> DataFrame:
    """The row with the smallest ``keep_by`` for each distinct
    ``subset``. Rows are grouped on a 256-bit digest, not on the text itself."""
    digest = F.unhex(content_digest(*[column(c) for c in subset]))
    return _one_row(df, [digest], names(keep_by), F.min, F.min_by)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, such as the last log line of a run."""
    return _one_row(df, [column(k) for k in names(key)], names(order), F.max, F.max_by)
