"""Best-fit decreasing packing of tokenised documents into sequences.

Tasks tokenise whole texts and cut the long ones into pieces. What best-fit
decreasing does with the pieces depends on their lengths alone, so it runs on the
counts of the lengths, at most one number for each length up to the sequence's, with
a segment tree over remaining capacities that finds the tightest open bin. It gives
runs: pieces a to b of this length go to sequences from s on, k to each, behind u
tokens. Pieces get their number within their length by counting inside ranges of a
digest, and look up their run: texts and tokens are never shuffled.

Defined results: null text is empty (one piece, the closing id alone); equal rows are
packed as often as they are there; a null key is carried through; columns other than
the two named are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import give_back_memory, shuffle_tasks, stored

LENGTH = 2048
EOS = 0
#: Pieces of the same length are numbered in ranges of at most about so many, and of
#: about a quarter of a task's share of all pieces.
PIECES_PER_RANGE = 200_000
#: Texts are taken in slices of about so many bytes.
SLICE_BYTES = 4 << 20

#: Characters that every version of the Unicode tables has sorted alike into letters,
#: digits, white space and the rest.
_STEADY = re.compile("[\t\n\r -~\u00a1-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")


def encoder(tokenizer: str, ranks: str | None, specials_are_text: bool = False):
    """A function from texts to lists of ids, by the tokenizer file as it is loaded: the
    string of a special token in a text is that token, unless ``specials_are_text``.

    ``ranks`` may name the same vocabulary as a list of ranks. It gives the same ids
    several times faster for texts of steady characters; all others go to the
    tokenizer file itself, whose tables decide what is a letter. A task loads what it
    needs and drops it when it ends: workers live on for other stages.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = []

    def by_file(texts: list[str]) -> list[list[int]]:
        if not loaded:
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(tokenizer))
            loaded[0].encode_special_tokens = specials_are_text
        return [e.ids for e in loaded[0].encode_batch_fast(texts, add_special_tokens=False)]

    if ranks is None:
        return by_file
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    with open(tokenizer, encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]] if not specials_are_text else []

    def encode(texts: list[str]) -> list[list[int]]:
        steady = [_STEADY.fullmatch(t) is not None and not any(s in t for s in added) for t in texts]
        rest = [t for t, ok in zip(texts, steady, strict=True) if not ok]
        others = iter(by_file(rest) if rest else ())
        return [fast.encode_ordinary(t) if ok else next(others) for t, ok in zip(texts, steady, strict=True)]

    return encode


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    group = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(sizes)]
    return zip(edges[:-1], edges[1:], strict=True)


PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


def _cut(length: int):
    def cut(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
        full = np.array([*ids, EOS], "<u4")
        first = len(full) % length or length
        starts = [0, *range(first, len(full), length)]
        ends = [*starts[1:], len(full)]
        view = memoryview(full).cast("B")
        return starts, [b - a for a, b in zip(starts, ends, strict=True)], [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]

    return cut


def pieces(df: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32. The first piece of a
    long document is the short one."""
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode, cut = encoder(tokenizer, ranks), _cut(length)
        for batch in batches:
            for a, b in slices(batch.column("text")):
                part = batch.slice(a, b - a)
                made = [cut(ids) for ids in encode(part.column("text").to_pylist())]
                counts = np.fromiter((len(m[0]) for m in made), np.int64, len(made))
                columns = [np.fromiter((v for m in made for v in m[k]), np.int64, int(counts.sum())) for k in range(3)]
                places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(np.repeat(np.arange(len(made)), counts))), pa.array(places.astype(np.int32)), *map(pa.array, columns)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
            give_back_memory()

    return rows.mapInArrow(run, f"doc_id {kind}, {PIECE_SCHEMA}").withColumnRenamed("doc_id", key)


class SegmentTree:
    """Which capacities have an open bin; finds the smallest from one on."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.any = [False] * (2 * self.width)

    def put(self, at: int, value: bool) -> None:
        at += self.width
        self.any[at] = value
        while at > 1:
            at //= 2
            value = self.any[2 * at] or self.any[2 * at + 1]
            if self.any[at] == value:
                return
            self.any[at] = value

    def first_from(self, at: int) -> int | None:
        """The smallest capacity of at least ``at`` that has a bin."""
        at += self.width
        if self.any[at]:
            return at - self.width
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.width
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], length: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (piece length, first piece, pieces, first sequence, pieces per sequence,
    tokens before) and the number of sequences. Placing one piece after the other in
    the tightest sequence with room gives the same, but that equal sequences are
    taken together."""
    tree = SegmentTree(length + 1)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def add(capacity: int, first: int, n: int) -> None:
        if capacity > 0 and n:
            open_bins.setdefault(capacity, []).append((first, n))
            tree.put(capacity, True)

    for size in sorted(counts, reverse=True):
        done, left = 0, counts[size]
        while left:
            capacity = tree.first_from(size)
            if capacity is None:  # new sequences for all that is left
                capacity, each = length, length // size
                first, bins = sequences, -(-left // each)
                sequences += bins
            else:
                first, bins = open_bins[capacity].pop()
                if not open_bins[capacity]:
                    tree.put(capacity, False)
                each = capacity // size
            full = min(bins, left // each)
            if full:
                runs.append((size, done, full * each, first, each, length - capacity))
                add(capacity - each * size, first, full)
                done, left, first, bins = done + full * each, left - full * each, first + full, bins - full
            if left and bins:  # the last one takes fewer
                runs.append((size, done, left, first, each, length - capacity))
                add(capacity - left * size, first, 1)
                done, left, first, bins = done + left, 0, first + 1, bins - 1
            add(capacity, first, bins)
    return runs, sequences


def pack(pieces: DataFrame, length: int = LENGTH, key: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # a row per length
    runs, _ = best_fit_decreasing(counts, length)
    table = spark.createDataFrame(runs or [(0,) * 6], "length long, _first long, _pieces long, _sequence long, _each long, _used long")
    longest, every = max(counts.values(), default=1), max(1, sum(counts.values()))
    ranges = max(1, -(-longest // PIECES_PER_RANGE), 4 * shuffle_tasks(spark) * longest // every)
    columns = [key, "piece", "start", "length", "ids_crc32"]
    rows = pieces.withColumn("_r", F.pmod(F.xxhash64(*columns), F.lit(ranges)).cast("int"))
    # A third of all rows may be equal: equal pieces are one row that counts them.
    rows = rows.groupBy(*columns, "_r").agg(F.count("*").alias("_n"))
    base = rows.groupBy("length", "_r").agg(F.sum("_n").alias("_c"))
    before = F.sum("_c").over(W.partitionBy("length").orderBy("_r").rowsBetween(W.unboundedPreceding, 0)) - F.col("_c")
    inside = F.sum("_n").over(W.partitionBy("length", "_r").orderBy(key, "piece", "start", "ids_crc32").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    rows = rows.withColumn("_in", inside).join(base.select("length", "_r", before.alias("_base")), ["length", "_r"])
    rows = rows.select(*columns, "_base", "_in", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    rows = rows.select(*columns, (F.col("_base") + F.col("_in") + F.col("_i")).alias("_rank"))
    table = table.select(F.col("length").alias("_length"), *table.columns[1:])
    found = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_pieces"))
    at = F.col("_rank") - F.col("_first")
    each = F.col("_each")
    return rows.join(F.broadcast(table), found).select(
        *columns,
        (F.col("_sequence") + F.floor(at / each)).alias("sequence_id"),
        (F.col("_used") + (at % each) * F.col("length")).alias("offset"),
    )


def pack_documents(df: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packs every document of ``df``; one row per piece."""
    return pack(stored(pieces(df, tokenizer, ranks, length, key, text), "pieces"), length, key)
