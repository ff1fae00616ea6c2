"""A sidecar of token counts per file, so that a token budget picks files.

The sidecar has a row per Parquet file of a table: its size and time of change, its
rows and tokens, and the range of its keys. It is made once, with one pass that
tokenises. A budget then adds up files on the driver (a row per file), reads the files
that lie below it as they are, and looks closer only where it ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.packing import repeat_epochs, take_token_budget


class StaleSidecar(ValueError):
    """The table or the count is not the one that the sidecar was made for."""


def _files(spark: SparkSession, table: str) -> dict[str, tuple[int, int]]:
    """Size and time of change of every file that a reader of the table would read."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    out, todo = {}, [fs.getFileStatus(hadoop.Path(table))]
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        else:
            out[status.getPath().toString()] = (status.getLen(), status.getModificationTime())
    return out


def _plain(path: Column) -> Column:
    """Readers name files as URIs."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def write_token_counts(spark: SparkSession, table: str, sidecar: str, tokens: Column, order_by: str) -> None:
    """Makes the sidecar of the Parquet table at ``table``: ``tokens`` is the number of
    tokens of a row, ``order_by`` the column whose order a budget follows."""
    listed = _files(spark, table)
    rows = spark.read.parquet(table).select(_plain(F.col("_metadata.file_path")).alias("file"), F.col(order_by).alias("key"), tokens.cast("bigint").alias("n"))
    counted = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"), F.count_if(F.col("key").isNull()).alias("n_null"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    known = spark.createDataFrame([(p, *v) for p, v in listed.items()], "path string, size bigint, changed bigint").withColumn("file", _plain(F.col("path")))
    joined = known.join(counted, "file", "left").drop("file")
    joined.select("*", F.lit(str(tokens)).alias("tokens"), F.lit(order_by).alias("order_by")).coalesce(1).write.mode("overwrite").parquet(sidecar)


def _clusters(entries: list) -> list[list]:
    """Files in the order of their keys; those whose ranges meet are one."""
    out: list[list] = []
    high = None
    # A null key comes first in the order.
    for e in sorted(entries, key=lambda e: (e["n_null"] == 0, e["low"] is not None, e["low"] if e["low"] is not None else 0)):
        apart = out and not e["n_null"] and high is not None and e["low"] > high
        apart = apart or (out and not e["n_null"] and high is None)
        if not out or apart:
            out.append([])
        out[-1].append(e)
        if e["high"] is not None and (high is None or e["high"] > high):
            high = e["high"]
    return out


def take_counted_budget(spark: SparkSession, table: str, sidecar: str, tokens: Column, order_by: str, budget: int, out: str = "epoch") -> DataFrame:
    """The rows that ``take_token_budget`` takes of the table, by its sidecar: files
    behind the end of the budget are not read, and only rows of the files in which it
    ends are counted. A table or a ``tokens`` other than the sidecar's is an error."""
    entries = spark.read.parquet(sidecar).collect()  # a row per file
    have = _files(spark, table)
    if {e["path"]: (e["size"], e["changed"]) for e in entries} != have:
        raise StaleSidecar(f"{table} has changed since {sidecar} was made")
    if any((e["tokens"], e["order_by"]) != (str(tokens), order_by) for e in entries):
        raise StaleSidecar(f"{sidecar} counts other tokens, or in another order")
    whole_table = spark.read.parquet(table)
    read = lambda part: spark.read.schema(whole_table.schema).option("basePath", table).parquet(*[e["path"] for e in part])
    filled = [e for e in entries if e["n_rows"]]
    every = sum(e["n_tokens"] for e in filled)
    if budget <= 0 or not filled:
        return whole_table.filter(F.lit(False)).withColumn(out, F.lit(0).cast("int"))
    if not every:
        return whole_table.withColumn(out, F.lit(0).cast("int"))
    passes, rest = divmod(budget, every)
    below, ends_in = [], None
    for cluster in _clusters(filled):
        size = sum(e["n_tokens"] for e in cluster)
        if size > rest:
            ends_in = cluster
            break
        below += cluster
        rest -= size
    parts = [repeat_epochs(whole_table, passes, out)] if passes else []
    number = F.lit(passes).cast("int").alias(out)
    if below:
        parts.append(read(below).select("*", number))
    if ends_in is not None and rest:
        counted = read(ends_in).withColumn("__n", tokens.cast("bigint"))
        parts.append(take_token_budget(counted, "__n", order_by, rest, out).drop("__n", out).select("*", number))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result
