"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import scratch_path

#: A word is a run of characters other than the space and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """The named columns of one Parquet table, and nothing else of it."""
    return spark.read.parquet(f"{folder}/{table}.parquet").select(*columns)


def words_of(text: str | Column) -> Column:
    """The words of a text, unchanged; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the folder that the cluster shares and reads them back:
    what follows does not run the steps before again, also when an executor is
    lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back_memory() -> None:
    """Returns what a Python worker has freed to the system. Workers are used again by
    later stages, and an executor's memory is shared between them and its JVM."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
