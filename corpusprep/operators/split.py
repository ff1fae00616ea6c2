"""Train and evaluation splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.strings import seeded_md5

SPACE = 1 << 32


def split_draw(key: str | Sequence[str], seed: int) -> Column:
    """A number of 32 bits that depends only on the seed and the key."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.conv(F.substring(seeded_md5(seed, *keys), 1, 8), 16, 10).cast("bigint")


def split_bounds(weights: Mapping[str, float]) -> list[tuple[str, int]]:
    """Each split and the end of its range of draws, by weights that need not add to 1.
    A positive weight too small for a range of its own is an error, so that no split
    silently stays empty."""
    total = sum(weights.values())
    if not weights or min(weights.values()) < 0 or total <= 0:
        raise ValueError(f"weights must be zero or more, and not all zero: {dict(weights)}")
    last = max(i for i, w in enumerate(weights.values()) if w > 0)
    bounds, so_far, before = [], 0.0, 0
    for i, (name, weight) in enumerate(weights.items()):
        so_far += weight
        end = SPACE if i >= last else round(SPACE * so_far / total)
        if weight > 0 and end == before:
            raise ValueError(f"weight {weight} of {name!r} is too small: its range of draws is empty")
        bounds.append((name, end))
        before = end
    return bounds


def split_label(weights: Mapping[str, float], key: str | Sequence[str], seed: int = 42) -> Column:
    """The name of the split a row falls in."""
    draw, before, label = split_draw(key, seed), 0, None
    for name, end in split_bounds(weights):
        if end > before:
            label = F.when(draw < end, F.lit(name)) if label is None else label.when(draw < end, F.lit(name))
        before = end
    return label


def split_by_hash(
    df: DataFrame, weights: Mapping[str, float], key: str | Sequence[str], seed: int = 42, out: str = "split"
) -> DataFrame:
    """Adds the split as a column: no shuffle, one write, and the same rows in
    each split however the data is partitioned. Key on the text (or its digest)
    to keep exact copies on one side."""
    return df.withColumn(out, split_label(weights, key, seed))


def split_random(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """``randomSplit``, for those who need its draw. The rows in each part change
    with the partitioning; ``split_by_hash`` does not."""
    return df.randomSplit(list(weights), seed=seed)


def select_corpus(
    df: DataFrame,
    dataset: str,
    subset: str,
    splits: Mapping[str, float] | None = None,
    key: str | Sequence[str] = "doc_id",
    seed: int = 42,
    dataset_col: str = "source",
    subset_col: str = "lang",
) -> DataFrame:
    """The rows of one dataset and subset (both filters reach the scan), with
    the named split of each when ``splits`` is given."""
    chosen = df.filter((F.col(dataset_col) == dataset) & (F.col(subset_col) == subset))
    return chosen if splits is None else split_by_hash(chosen, splits, key, seed)
