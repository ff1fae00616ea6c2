"""Fixed-length samples, shuffles, batches and budgets over a token corpus."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.strings import seeded_md5
from corpusprep.functions.tokens import DEFAULT_EOS, with_eos
from corpusprep.operators.ordering import (
    bucket_bases,
    bucket_of,
    column,
    names,
    range_bounds,
    running_start,
    with_position,
    within_bucket,
)

# The sample length, batch size and seed of the training runs.
SAMPLE_LENGTH = 2048
BATCH_SIZE = 1024
SHUFFLE_SEED = 17

# A task cuts samples out of ranges of about so many tokens.
TOKENS_PER_RANGE = 65_536


def pack_tokens(
    df: DataFrame,
    tokens: Column,
    order_by: str | Sequence[str],
    length: int = SAMPLE_LENGTH,
    eos: str | int | None = DEFAULT_EOS,
    group_by: str | Sequence[str] = (),
    drop_tail: bool = True,
) -> DataFrame:
    """All tokens of a group, in order, cut into samples of ``length`` tokens.

    Returns the group columns, ``sample`` (from 0) and ``tokens``. The short
    last sample is left out unless ``drop_tail`` is false; tokens that do not
    follow on each other stop the job. ``tokens`` is an expression and runs twice,
    once to count and once to cut: documents are shuffled as text, to the range of
    samples they fall in, and their tokens never. Only the few that reach into a
    second range are sent as slices of their tokens.
    """
    group, order = names(group_by), names(order_by)
    full = tokens if eos is None else with_eos(tokens, eos)
    keys = [*group, *order]
    span = length * max(1, TOKENS_PER_RANGE // length)

    # Where each document starts, from keys and counts alone.
    bounds = range_bounds(df, keys)
    bucket = bucket_of(df, keys, bounds)
    size = F.coalesce(F.size(tokens) + (0 if eos is None else 1), F.lit(0)).cast("bigint")
    counts = df.select(*[column(k) for k in keys], size.alias("_n"))
    starts = running_start(counts, F.col("_n"), order_by, group, "_start", bucket, shared_shuffle=True, one_bucket=not bounds)
    starts = starts.filter("_n > 0").select(*[column(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_start", "_n")
    # Keys are unique, so the parts of this side are even; hashed, they spare the
    # sort of the documents.
    same = reduce(Column.__and__, [column(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    placed = df.join(starts.hint("shuffle_hash"), same).drop(*[f"_k{i}" for i in range(len(keys))])

    # A document that ends in the range it starts in goes there as it is; another
    # goes to each range as the tokens that belong there.
    first_range, last_range = F.expr(f"_start div {span}"), F.expr(f"(_start + _n - 1) div {span}")
    crosses = first_range != last_range
    others = [c for c in df.columns if c not in group]
    opened = placed.withColumn("_tokens", F.when(crosses, full))
    touched = opened.withColumn("_range", F.explode(F.sequence(first_range, last_range)))
    begin = F.greatest(F.col("_range") * span, F.col("_start"))
    end = F.least((F.col("_range") + 1) * span, F.col("_start") + F.col("_n"))
    part = F.slice("_tokens", (begin - F.col("_start") + 1).cast("int"), (end - begin).cast("int"))
    sent = touched.select(
        *[column(g) for g in group],
        *[F.when(~crosses, column(c)).alias(c) for c in others],
        "_range",
        begin.alias("_first"),
        (end - begin).alias("_size"),
        F.when(crosses, part).alias("_part"),
    ).repartition(*[column(g) for g in group], "_range")

    # The rest happens where the rows are: (group, range) is one task's work.
    by = [column(g) for g in group]
    cut = sent.select(*by, "_range", F.struct("_first", "_size", F.coalesce("_part", full).alias("part")).alias("_piece"))
    gathered = cut.groupBy(*by, "_range").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    follows = F.forall(
        F.zip_with("_pieces", F.slice("_pieces", 2, F.greatest(F.size("_pieces"), F.lit(1))), lambda a, b: F.coalesce(a["_first"] + a["_size"] == b["_first"], F.lit(True))),
        lambda ok: ok,
    ) & (F.get("_pieces", 0)["_first"] == F.col("_range") * span)
    stop = F.raise_error(F.lit(f"tokens in the order of {order} do not follow on each other"))
    joined = gathered.withColumn("_all", F.when(~follows, stop).otherwise(F.flatten("_pieces.part")))
    samples = F.sequence(F.lit(0), F.expr(f"(size(_all) - 1) div {length}"))
    out = joined.select(*by, "_range", "_all", F.explode(samples).alias("_i")).select(
        *by,
        (F.col("_range") * (span // length) + F.col("_i")).alias("sample"),
        F.slice("_all", F.col("_i") * length + 1, length).alias("tokens"),
    )
    return out.filter(F.size("tokens") == length) if drop_tail else out


def shuffle_rows(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = SHUFFLE_SEED,
    group_by: str | Sequence[str] = (),
    out: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Adds a place in a seeded random order, and as ``total`` the number of rows. The
    order comes from a digest of the key, so it is the same on every run and for
    every partitioning. The keys are read in a pass of their own: write rows that
    were costly to make first."""
    keys = names(key)
    drawn = df.withColumn("_draw", seeded_md5(seed, *[column(k) for k in keys]))
    # Digests are spread evenly, so their first four digits make 65,536 even
    # buckets; with groups in front the buckets have to be drawn.
    bucket = None if group_by else F.conv(F.substring("_draw", 1, 4), 16, 10).cast("bigint")
    return with_position(drawn, ["_draw", *keys], group_by, out, bucket, total).drop("_draw")


def shuffle_into_order(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = SHUFFLE_SEED,
    partitions: int | None = None,
    out: str = "position",
    total: str | None = None,
) -> DataFrame:
    """``shuffle_rows`` with the rows themselves in that order: partition by partition,
    and within each, so part files in the order of their names are the shuffle. One
    exchange moves the rows; the places come from counts of the keys alone."""
    keys = names(key)
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if not 1 <= tasks <= 65_536:
        raise ValueError(f"partitions must be from 1 to 65536, not {tasks}")
    drawn = df.withColumn("_draw", seeded_md5(seed, *[column(k) for k in keys]))
    # The first digits are even ranges, so ranges of them are even partitions.
    place = F.expr(f"cast(cast(conv(substring(_draw, 1, 4), 16, 10) as bigint) * {tasks} div 65536 as int)")
    counts = drawn.select(place.alias("_at")).groupBy("_at").agg(F.count(F.lit(1)).alias("_rows"))
    counts = {r["_at"]: r["_rows"] for r in counts.collect()}  # a number per partition
    bases, so_far = [], 0
    for i in range(tasks):
        bases.append(so_far)
        so_far += counts.get(i, 0)
    ordered = drawn.withColumn("_at", place).repartitionById(tasks, "_at")
    ordered = ordered.sortWithinPartitions("_draw", *[column(k) for k in keys], F.xxhash64(*[column(c) for c in df.columns]))
    base = F.get(F.from_json(F.lit(json.dumps(bases)), "array<bigint>"), F.col("_at"))
    # Within a partition the id counts its rows in their order.
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    added = [(base + in_part).alias(out)] + ([F.lit(so_far).cast("bigint").alias(total)] if total else [])
    return ordered.select(*[column(c) for c in df.columns], *added)


def assign_batches(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    position: str = "position",
    drop_last: bool = False,
    out: str = "batch",
    group_by: str | Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Adds the batch of each row from its dense position (from 0) in its group.
    ``drop_last`` leaves out the short last batch of each group. ``total`` names a
    column with the group's rows, as ``with_position`` gives it; without it they are
    counted, which runs what made ``df`` once more."""
    batched = df.withColumn(out, F.expr(f"`{position}` div {int(batch_size)}"))
    if not drop_last:
        return batched
    if total is not None:
        return batched.filter(F.col(out) < F.expr(f"`{total}` div {int(batch_size)}"))
    group = names(group_by)
    full = df.groupBy(*[column(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.expr(f"count(1) div {int(batch_size)}").alias("_full"))
    if not group:
        return batched.filter(F.col(out) < full.scalar())
    same = reduce(Column.__and__, [column(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)])
    return batched.join(full, same).filter(F.col(out) < F.col("_full")).select(*[column(c) for c in batched.columns])


def eval_subset(df: DataFrame, batches: int = -1, batch: str = "batch") -> DataFrame:
    """The first ``batches`` batches; -1 keeps all."""
    return df if batches == -1 else df.filter(F.col(batch) < batches)


def take_token_budget(df: DataFrame, tokens: str, order_by: str | Sequence[str], budget: int, out: str = "epoch") -> DataFrame:
    """Rows in order until ``budget`` tokens are reached, with the pass over the data,
    from 0; the row that reaches it is the last one kept. A budget above one pass
    goes on with the next.

    Counts are summed by bucket, and ordered only in the bucket where the budget
    ends. The result of the last pass is a filter on the key, which reaches the scan
    when the key is one column: no text is shuffled.
    """
    order = names(order_by)
    number = F.lit(0).cast("int").alias(out)
    if budget <= 0:
        return df.select("*", number).filter(F.lit(False))
    bounds = range_bounds(df, order)
    rows = df.select(*[column(c) for c in order], column(tokens).alias("_n")).withColumn("_bucket", bucket_of(df, order, bounds))
    bases = bucket_bases(rows, F.col("_n"), "_bucket")
    every = bases.agg(F.sum("_sum")).first()[0] or 0
    if not every:
        return df.select("*", number)  # no budget can be reached
    passes, rest = divmod(budget, every)
    whole = repeat_epochs(df, passes, out) if passes else None
    if not rest:
        return whole
    ends_in = bases.filter((F.col("_base") < rest) & (F.col("_base") + F.col("_sum") >= rest)).first()
    last_bucket = rows.filter(within_bucket(df, order, bounds, ends_in["_bucket"]))
    one = F.lit(0).cast("bigint")
    placed = running_start(last_bucket, F.col("_n"), order, out="_start", bucket=one, one_bucket=True)
    before = placed.filter(F.col("_start") + ends_in["_base"] < rest)
    key = column(order[0]) if len(order) == 1 else F.struct(*[column(c) for c in order])
    last = before.agg(F.max(key)).first()[0]
    # A null key comes first in the order, as it does in a sort.
    if len(order) == 1:
        kept = df.filter(key.isNull() | (key <= F.lit(last)))
    else:
        kinds = [df.schema[c].dataType for c in order]
        reached = F.struct(*[F.lit(v).cast(k) for v, k in zip(last, kinds)])
        kept = df.filter(key <= reached)
    kept = kept.select("*", F.lit(passes).cast("int").alias(out))
    return kept if whole is None else whole.unionAll(kept)


def repeat_epochs(df: DataFrame, epochs: int, out: str = "epoch") -> DataFrame:
    """Every row once for each pass over the data, passes numbered from 0."""
    if epochs < 1:
        raise ValueError(f"epochs must be 1 or more, not {epochs}")
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def take_duration(
    df: DataFrame,
    duration: str,
    tokens: str,
    order_by: str | Sequence[str],
    batch_size: int = BATCH_SIZE,
    length: int = SAMPLE_LENGTH,
) -> DataFrame:
    """The rows a run of ``duration`` reads, and in ``epoch`` the pass it reads them in:
    ``10000000tok``, ``10ep`` or ``500ba`` (batches of ``batch_size`` samples of
    ``length`` tokens)."""
    parsed = re.fullmatch(r"([0-9_]+)(tok|ep|ba)", duration)
    if parsed is None:
        raise ValueError(f"duration must be like '10000000tok', '10ep' or '500ba', not {duration!r}")
    amount = int(parsed[1])
    if parsed[2] == "ep":
        return repeat_epochs(df, amount)
    return take_token_budget(df, tokens, order_by, amount * (batch_size * length if parsed[2] == "ba" else 1))


def _report(tokens: str, length: int, batch_size: int) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(tokens).alias("n_tokens"),
        F.expr(f"sum(`{tokens}`) div {int(length)}").alias("full_samples"),
        F.expr(f"sum(`{tokens}`) div {int(length)} div {int(batch_size)}").alias("full_batches"),
    ]


def token_report(
    df: DataFrame,
    tokens: str,
    by: str | Sequence[str],
    length: int = SAMPLE_LENGTH,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Rows, tokens, full samples and full batches for each value of ``by``."""
    return df.groupBy(*names(by)).agg(*_report(tokens, length, batch_size))


def token_cube(
    df: DataFrame,
    tokens: str,
    by: Sequence[str],
    sets: Sequence[Sequence[str]] | None = None,
    length: int = SAMPLE_LENGTH,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``token_report`` for several groupings at once, with one pass and one shuffle: the
    given sets of the columns ``by``, or all of them down to the total. Columns that a
    row is not grouped by are null; ``grouping`` has a bit for each of them, the first
    column's is the highest, which tells them from values that are null."""
    columns = [column(c) for c in by]
    unknown = {c for s in sets or [] for c in s} - set(by)
    if unknown:
        raise ValueError(f"sets name columns that are not in by: {sorted(unknown)}")
    grouped = df.cube(*columns) if sets is None else df.groupingSets([[column(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.grouping_id().cast("bigint").alias("grouping"), *_report(tokens, length, batch_size))
