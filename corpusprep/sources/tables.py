"""Tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A catalog table, or ``<folder>/<name>.parquet`` when a folder is given."""
    if folder is None:
        return spark.read.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_packed(df: DataFrame, out_root: str, split_col: str = "split", mode: str = "error") -> None:
    """Packed samples as Parquet, a folder for each split."""
    df.write.partitionBy(split_col).mode(mode).parquet(out_root)


def read_packed(spark: SparkSession, out_root: str, split: str | None = None, split_col: str = "split") -> DataFrame:
    """All splits, or one of them: then only its folder is read."""
    packed = spark.read.parquet(out_root)
    return packed if split is None else packed.filter(packed[split_col] == split)
