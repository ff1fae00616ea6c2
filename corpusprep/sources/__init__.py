"""Sources and sinks."""

from corpusprep.sources.counted import StaleSidecar, take_counted_budget, write_token_counts
from corpusprep.sources.lines import read_chat_jsonl, write_jsonl
from corpusprep.sources.shards import SampleShards, drop_unlisted, read_shards, shard_of, shuffle_spread, shuffled_shards, write_shards
from corpusprep.sources.tables import read_packed, read_table, write_packed
from corpusprep.sources.text_folder import (
    NameCollision,
    export_name_collisions,
    read_text_folder,
    write_text_folder,
)

__all__ = [
    "NameCollision",
    "SampleShards",
    "StaleSidecar",
    "drop_unlisted",
    "export_name_collisions",
    "read_chat_jsonl",
    "read_packed",
    "read_shards",
    "read_table",
    "read_text_folder",
    "shard_of",
    "shuffle_spread",
    "shuffled_shards",
    "take_counted_budget",
    "write_jsonl",
    "write_packed",
    "write_shards",
    "write_text_folder",
    "write_token_counts",
]
