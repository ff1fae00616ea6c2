"""JSON lines: chat records or prompt/response pairs, one per line."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.chat import CHAT_SCHEMA


def write_jsonl(
    df: DataFrame,
    path: str,
    column: str = "message",
    split_col: str | None = None,
    single_file: bool = False,
    mode: str = "error",
) -> None:
    """Writes one column as lines, as a folder of shards; with ``split_col``, one
    pass writes a folder for each split.

    ``single_file`` writes the one file ``path`` instead, the lines in the order of the
    shards. Shards are written first; each has its place in the file by the sizes of those
    before it. On a folder that all executors share, tasks then copy shards to their
    places side by side; HDFS joins them without a copy. A store that can do neither is
    an error: write shards there.
    """
    if split_col is not None:
        if single_file:
            raise ValueError("a single file holds one split: filter the split first")
        df.select(column, split_col).write.partitionBy(split_col).mode(mode).text(path)
    elif not single_file:
        df.select(column).write.mode(mode).text(path)
    else:
        _write_one_file(df.select(column), path, mode)


def _write_one_file(lines: DataFrame, path: str, mode: str) -> None:
    spark = lines.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode not in ("error", "overwrite"):
        raise ValueError(f"mode must be 'error' or 'overwrite', not {mode!r}")
    if mode == "error" and fs.exists(target):
        raise FileExistsError(f"{path} exists; use mode 'overwrite' to replace it")

    # A staging folder of its own: several writes may run side by side.
    stage = hadoop.Path(f"{path}.stage-{uuid.uuid4().hex}")
    shards, whole = f"{stage.toString()}/shards", f"{stage.toString()}/whole"
    try:
        lines.write.text(shards, lineSep="\n")
        parts = sorted((x for x in fs.listStatus(hadoop.Path(shards)) if x.getPath().getName().startswith("part-") and x.getLen()), key=lambda x: x.getPath().getName())
        if fs.getScheme() == "file":
            _copy_to_places(spark, [(x.getPath().toUri().getPath(), x.getLen()) for x in parts], hadoop.Path(whole).toUri().getPath())
        elif len(parts) == 1:
            whole = parts[0].getPath().toString()
        else:
            _concatenate(spark, fs, [x.getPath() for x in parts], hadoop.Path(whole))
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(hadoop.Path(whole), target):
            raise RuntimeError(f"could not move {whole} to {path}")
    finally:
        fs.delete(stage, True)


def _copy_to_places(spark: SparkSession, parts: list[tuple[str, int]], whole: str) -> None:
    """Copies files behind each other into one, side by side. A task that runs again
    writes the same bytes to the same place."""
    ends = list(accumulate((size for _, size in parts), initial=0))
    with open(whole, "wb") as f:
        f.truncate(ends[-1])
    if not parts:
        return

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open(row["part"], "rb") as source, open(whole, "r+b") as f:
                    f.seek(row["place"])
                    shutil.copyfileobj(source, f, 8 << 20)
                    copied = f.tell() - row["place"]
                yield pa.RecordBatch.from_pydict({"copied": [copied]})

    places = [(part, place) for (part, _), place in zip(parts, ends)]
    rows = spark.createDataFrame(places, "part string, place long").repartition(len(places), "place")
    copied = rows.mapInArrow(copy, "copied long").agg(F.sum("copied")).first()[0]
    if copied != ends[-1]:
        raise RuntimeError(f"{copied} bytes of {ends[-1]} came to {whole}")


def _concatenate(spark: SparkSession, fs, parts: list, whole) -> None:
    """Joins files by what the file system has for it."""
    fs.create(whole).close()
    array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        array[i] = part
    try:
        fs.concat(whole, array)
    except UnsupportedOperationException:
        raise NotImplementedError(f"{fs.getScheme()} can neither be written at a place nor join files: write shards instead") from None


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``messages`` of each line; ``corrupt`` holds a line that is no record."""
    schema = f"{CHAT_SCHEMA}, corrupt STRING"
    return spark.read.schema(schema).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt")
