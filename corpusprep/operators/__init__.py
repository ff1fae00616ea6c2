"""DataFrame operators."""

from corpusprep.operators.filters import (
    all_filled,
    documented_functions,
    filter_null_or_empty,
    filter_report,
    load_and_filter,
)
from corpusprep.operators.ordering import range_bucket, running_start, with_position
from corpusprep.operators.packing import (
    SAMPLE_LENGTH,
    assign_batches,
    eval_subset,
    pack_tokens,
    repeat_epochs,
    shuffle_into_order,
    shuffle_rows,
    take_duration,
    take_token_budget,
    token_cube,
    token_report,
)
from corpusprep.operators.records import compare_responses, exchange_messages, extract_article, flatten_nested, map_text
from corpusprep.operators.reduce import dedup_exact, latest_per_key
from corpusprep.operators.runs import every_nth, rolling_mean, run_timeline
from corpusprep.operators.split import select_corpus, split_bounds, split_by_hash, split_label, split_random

__all__ = [
    "SAMPLE_LENGTH",
    "all_filled",
    "assign_batches",
    "compare_responses",
    "dedup_exact",
    "documented_functions",
    "eval_subset",
    "every_nth",
    "exchange_messages",
    "extract_article",
    "filter_null_or_empty",
    "filter_report",
    "flatten_nested",
    "latest_per_key",
    "load_and_filter",
    "map_text",
    "pack_tokens",
    "range_bucket",
    "repeat_epochs",
    "rolling_mean",
    "run_timeline",
    "running_start",
    "select_corpus",
    "shuffle_into_order",
    "shuffle_rows",
    "split_bounds",
    "split_by_hash",
    "split_label",
    "split_random",
    "take_duration",
    "take_token_budget",
    "token_cube",
    "token_report",
    "with_position",
]
