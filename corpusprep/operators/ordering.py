"""Running sums and positions over a whole table, without a one-task window.

Rows are cut into buckets, which are ranges of (group, order). A narrow pass
sums each bucket; the sums of the earlier buckets give its base; a window inside
the bucket adds the rest. A group that holds most of the rows is spread over
many buckets, and each bucket is one small unit of work.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 100_000
MIN_ROWS_PER_BUCKET = 50
MAX_BUCKETS = 65_536
SAMPLES_PER_BUCKET = 10
FAN_OUT = 16
KEY_CHARS = 64


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def column(name: str) -> Column:
    """A column by its name, which may hold blanks and dots."""
    return F.col(f"`{name.replace('`', '``')}`")


def _sort_key(columns: Sequence[str]) -> Column:
    return column(columns[0]) if len(columns) == 1 else F.struct(*[column(c).alias(f"_k{i}") for i, c in enumerate(columns)])


def _bucket_count(df: DataFrame, rows: int) -> int:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = max(4 * tasks, math.ceil(rows / ROWS_PER_BUCKET))
    return max(1, min(wanted, MAX_BUCKETS, rows // MIN_ROWS_PER_BUCKET))


def range_bounds(df: DataFrame, columns: Sequence[str], buckets: int | None = None, rows: int | None = None) -> list:
    """Upper ends of the buckets, from a sample of the keys: about ten keys for each
    bucket, of which one for each bucket comes to the driver. Strings are cut to
    KEY_CHARS characters, so the sample is bounded in bytes too. It only decides how
    even the buckets are; any bounds give the same result."""
    if buckets is not None and not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be from 1 to {MAX_BUCKETS}, not {buckets}")
    rows = df.count() if rows is None else rows
    buckets = buckets or _bucket_count(df, rows)
    if buckets < 2:
        return []
    is_text = {f.name: f.dataType.simpleString() in ("string", "binary") for f in df.schema.fields}
    cut = [F.substring(column(c), 1, KEY_CHARS) if is_text[c] else column(c) for c in columns]
    keys = df.select(*[k.alias(c) for k, c in zip(cut, columns)]).dropna()
    keys = keys.sample(fraction=min(1.0, 1.2 * SAMPLES_PER_BUCKET * buckets / max(rows, 1)), seed=17)
    drawn = keys.agg(F.array_sort(F.collect_list(_sort_key(columns))).alias("k"))
    step = F.greatest(F.lit(1), F.expr(f"size(k) div {buckets}"))
    picked = drawn.select(F.to_json(F.filter("k", lambda _, i: (i > 0) & (i % step == 0)))).first()[0]
    bounds = json.loads(picked or "[]")
    return [k for i, k in enumerate(bounds) if i == 0 or k != bounds[i - 1]]


def range_bucket(
    df: DataFrame, columns: str | Sequence[str], buckets: int | None = None, rows: int | None = None
) -> Column:
    """A bucket number that grows with ``columns``. The bounds enter the plan as
    constants, so a task that runs again puts its rows in the same buckets.
    ``rows`` spares the count when it is known."""
    columns = names(columns)
    return bucket_of(df, columns, range_bounds(df, columns, buckets, rows))


def bucket_of(df: DataFrame, columns: Sequence[str], bounds: list) -> Column:
    """The bucket number for bounds that are known."""
    if not bounds:
        return F.lit(0).cast("bigint")
    key = _sort_key(columns)
    return _rank(key, bounds, _key_type(df, key))


def within_bucket(df: DataFrame, columns: Sequence[str], bounds: list, bucket: int) -> Column:
    """The keys of one bucket as a plain range, which a scan can use to skip data when
    the key is one column."""
    key = _sort_key(columns)
    inside = F.lit(True)
    if bucket > 0:
        inside = key >= _constant(bounds[bucket - 1], _key_type(df, key))
    if bucket < len(bounds):
        inside = inside & (key < _constant(bounds[bucket], _key_type(df, key)))
    return inside if bucket > 0 else key.isNull() | inside


def _key_type(df: DataFrame, key: Column) -> str:
    return df.select(key.alias("k")).schema["k"].dataType.simpleString()


def _constant(value, value_type: str) -> Column:
    return F.get(F.from_json(F.lit(json.dumps([value])), f"array<{value_type}>"), 0)


def _rank(key: Column, bounds: list, key_type: str) -> Column:
    """How many bounds are at or below the key, found level by level: each level
    is FAN_OUT times finer than the one before and looks at one node of it."""
    # A lambda over a one-element array gives a value a name inside an
    # expression, so that it is computed once and not for every comparison.
    return F.get(F.transform(F.array(key.cast(key_type)), lambda k: _reached(k, bounds, key_type)), 0)


def _reached(key: Column, bounds: list, key_type: str) -> Column:
    levels = [bounds]
    while len(levels[0]) > FAN_OUT:
        levels.insert(0, levels[0][::FAN_OUT])

    def reached(node: Column) -> Column:
        return F.size(F.filter(node, lambda bound: bound <= key)) - 1

    def one_level_down(at: Column, level: list) -> Column:
        nodes = [level[i : i + FAN_OUT] for i in range(0, len(level), FAN_OUT)]
        tree = F.from_json(F.lit(json.dumps(nodes)), f"array<array<{key_type}>>")
        return F.get(F.transform(F.array(at), lambda i: i * FAN_OUT + reached(F.get(tree, i))), 0)

    at = reached(F.from_json(F.lit(json.dumps(levels[0])), f"array<{key_type}>"))
    for level in levels[1:]:
        at = one_level_down(at, level)
    return F.coalesce(at + 1, F.lit(0)).cast("bigint")


def bucket_bases(df: DataFrame, value: Column, bucket: str, group_by: Sequence[str] = ()) -> DataFrame:
    """For each (group, bucket), the sum of ``value`` in the group's earlier buckets,
    in this one, and in all, and how many buckets the group is in. Buckets are ranges
    of (group, order): only a bucket's first and last group can be in several."""
    return _bases_of(df.groupBy(*[column(g) for g in group_by], bucket).agg(F.sum(value).alias("_sum")), bucket, group_by)


def _bases_of(sums: DataFrame, bucket: str, group_by: Sequence[str]) -> DataFrame:
    by = [column(g) for g in group_by]
    earlier = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    whole = Window.partitionBy(*by)
    return sums.select(
        *by, bucket, base, "_sum", F.sum("_sum").over(whole).alias("_all"), F.count(F.lit(1)).over(whole).alias("_parts")
    )


def running_start(
    df: DataFrame,
    value: Column,
    order_by: str | Sequence[str],
    group_by: str | Sequence[str] = (),
    out: str = "start",
    bucket: Column | None = None,
    shared_shuffle: bool = False,
    total: str | None = None,
    one_bucket: bool = False,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before this one in its group, and as
    ``total`` that of the whole group.

    ``value`` must not be negative. ``order_by`` must tell all rows of a group
    apart; a tie stops the job, since its order could change when a task runs
    again. ``bucket`` may give the buckets as a column that grows with (group,
    order); otherwise they are drawn. ``one_bucket`` says that they all are the same.

    The bucket sums are a pass of their own over the columns they need, with
    hardly any shuffle. ``shared_shuffle`` takes them from the shuffled rows
    instead: better for few narrow columns that were costly to work out.
    """
    order, group = names(order_by), names(group_by)
    drawn = bucket is None
    if drawn:
        bounds = range_bounds(df, [*group, *order])
        bucket, one_bucket = bucket_of(df, [*group, *order], bounds), not bounds
    rows = df.withColumn("_bucket", bucket)
    by, ordered = [column(g) for g in group], [column(c) for c in order]
    # The window keeps the partitioning made here, and `value` is worked out
    # after it, over even buckets, however few and uneven the input splits are.
    moved = rows.repartition(*by, "_bucket").withColumn("_value", value)
    inside = Window.partitionBy(*by, "_bucket").orderBy(*ordered)
    whole = Window.partitionBy(*by, "_bucket")
    up_to_here = F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # Null-safe: two null keys are a tie, and the first row has none before it.
    same_as_before = [F.lag(c).over(inside).eqNullSafe(c) for c in ordered]
    tied = reduce(Column.__and__, same_as_before, F.row_number().over(inside) > 1)
    local = moved.withColumn("_total", up_to_here).withColumn("_tied", tied)
    if total is not None:
        local = local.withColumn("_here", F.sum("_value").over(whole))

    stop = F.raise_error(F.lit(f"order_by {order} does not tell all rows apart")).cast("bigint")
    before = F.col("_total") - F.col("_value")
    if one_bucket:  # nothing lies in an earlier one
        found = [F.when(F.col("_tied"), stop).otherwise(before).cast("bigint").alias(out)]
        found += [F.col("_here").cast("bigint").alias(total)] if total is not None else []
        return local.select(*[column(c) for c in df.columns], *found)
    if shared_shuffle:
        bases = _bases_of(local.groupBy(*by, "_bucket").agg(F.max("_total").alias("_sum")), "_bucket", group)
    else:
        bases = bucket_bases(rows, value, "_bucket", group)
    keyed = bases.filter("_base > 0" if total is None else "_parts > 1").select(
        *[column(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_bucket").alias("_b"), "_base", "_all"
    )
    if drawn:  # at most two rows for each of MAX_BUCKETS buckets
        keyed = F.broadcast(keyed)

    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(by):
        same = same & g.eqNullSafe(F.col(f"_g{i}"))
    start = before + F.coalesce("_base", F.lit(0))
    found = [F.when(F.col("_tied"), stop).otherwise(start).cast("bigint").alias(out)]
    if total is not None:
        found.append(F.coalesce("_all", "_here").cast("bigint").alias(total))
    return local.join(keyed, same, "left").select(*[column(c) for c in df.columns], *found)


def with_position(
    df: DataFrame,
    order_by: str | Sequence[str],
    group_by: str | Sequence[str] = (),
    out: str = "position",
    bucket: Column | None = None,
    total: str | None = None,
) -> DataFrame:
    """Adds the row's place in its group, from 0, and as ``total`` the group's rows:
    a ``row_number`` that a group of any size cannot push into one task."""
    return running_start(df, F.lit(1).cast("bigint"), order_by, group_by, out, bucket, total=total)
