"""Views of a run's log and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.ordering import with_position

ROWS_PER_BLOCK = 100_000


def run_timeline(df: DataFrame, run_col: str, order_by: str | Sequence[str], run=None, out: str = "position") -> DataFrame:
    """The events of one run, or of all runs, with their place in the run. Sort
    by run and place to list them."""
    events = df if run is None else df.filter(F.col(run_col) == run)
    return with_position(events, order_by, run_col, out)


def every_nth(df: DataFrame, n: int, run_col: str, order_by: str | Sequence[str], out: str = "step") -> DataFrame:
    """Rows n, 2n, 3n, ... of each run, with their step (from 1)."""
    numbered = with_position(df, order_by, run_col, out).withColumn(out, F.col(out) + 1)
    return numbered.filter(F.col(out) % n == 0)


def rolling_mean(
    df: DataFrame,
    run_col: str,
    order_by: str | Sequence[str],
    value: str,
    n: int = 10,
    out: str = "rolling_mean",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Mean of the last ``n`` values of the run, this row included.

    A run is cut into blocks of rows. The last n-1 rows of a block also go to
    the next one, as the history of its first rows, and are dropped again after
    the window: a long run is many small windows.
    """
    if not 1 <= n <= rows_per_block:
        raise ValueError(f"n must be from 1 to {rows_per_block}, not {n}")
    placed = with_position(df, order_by, run_col, "_position")
    block = F.expr(f"_position div {int(rows_per_block)}")
    feeds_next = F.col("_position") % rows_per_block >= rows_per_block - (n - 1)
    blocks = F.when(feeds_next, F.array(block, block + 1)).otherwise(F.array(block))
    spread = placed.withColumn("_own", block).withColumn("_block", F.explode(blocks))
    last_n = Window.partitionBy(run_col, "_block").orderBy("_position").rowsBetween(-(n - 1), 0)
    rolled = spread.withColumn(out, F.avg(value).over(last_n))
    return rolled.filter("_block = _own").select(*df.columns, out)
