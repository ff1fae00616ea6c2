"""Budgets by a sidecar of counts, reports over grouping sets, one file from shards."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io
from corpusprep.plans import QUERIES
from corpusprep.sources import lines



def table(spark, tmp_path, files, name="t"):
    """Each file holds the given (key, n) rows."""
    path = str(tmp_path / name)
    for rows in files:
        spark.createDataFrame(rows, "k long, n long").coalesce(1).write.mode("append").parquet(path)
    return path


def budget(spark, path, side, n):
    return sorted(((r["k"], r["epoch"]) for r in io.take_counted_budget(spark, path, side, F.col("n"), "k", n).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_budget_by_files_equals_budget_by_rows(spark, tmp_path, seed):
    r = random.Random(seed)
    keys = [*range(60), *([None] if seed == 1 else [])]
    rows = [(k, r.randint(1, 9)) for k in keys]
    # Ranges that follow each other, meet, and lie inside one another.
    cuts = [rows[:10], rows[10:20], rows[20:40:2], rows[21:40:2], rows[40:50] + rows[55:], rows[50:55]]
    path, side = table(spark, tmp_path, cuts), str(tmp_path / "side")
    io.write_token_counts(spark, path, side, F.col("n"), "k")
    df, total = spark.read.parquet(path), sum(n for _, n in rows)
    for n in (0, 1, 30, 77, total // 2, total - 1, total, total + 5, 3 * total + 100):
        want = op.take_token_budget(df, "n", "k", n)
        assert budget(spark, path, side, n) == sorted(((x["k"], x["epoch"]) for x in want.collect()), key=str), n


def test_only_files_up_to_the_budget_are_read(spark, tmp_path):
    path, side = table(spark, tmp_path, [[(10 * i + j, 1) for j in range(10)] for i in range(8)]), str(tmp_path / "side")
    io.write_token_counts(spark, path, side, F.col("n"), "k")
    taken = io.take_counted_budget(spark, path, side, F.col("n"), "k", 25)
    assert len(taken.inputFiles()) == 3 and taken.count() == 25
    assert len(io.take_counted_budget(spark, path, side, F.col("n"), "k", 20).inputFiles()) == 2


def test_stale_sidecar_is_refused(spark, tmp_path):
    path, side = table(spark, tmp_path, [[(1, 5)], [(2, 5)]]), str(tmp_path / "side")
    io.write_token_counts(spark, path, side, F.col("n"), "k")
    with pytest.raises(io.StaleSidecar, match="other tokens"):
        io.take_counted_budget(spark, path, side, F.col("n") + 1, "k", 3)
    table(spark, tmp_path, [[(3, 5)]])
    with pytest.raises(io.StaleSidecar, match="has changed"):
        io.take_counted_budget(spark, path, side, F.col("n"), "k", 3)
    io.write_token_counts(spark, path, side, F.col("n"), "k")
    assert budget(spark, path, side, 11) == [(1, 0), (2, 0), (3, 0)]


def test_empty_table(spark, tmp_path):
    path, side = table(spark, tmp_path, [[]]), str(tmp_path / "side")
    io.write_token_counts(spark, path, side, F.col("n"), "k")
    assert budget(spark, path, side, 10) == []


def test_cube_has_one_exchange(spark, sf):
    text = plan(QUERIES["token_cube"](spark, sf))
    assert text.count("Exchange ") == 1 and text.count("Scan parquet") == 1


def test_grouping_sets_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", "x", 3), (None, "x", 2)], "g string, h string, n long")
    rows = op.token_cube(df, "n", ["g", "h"], sets=[["g"], []], length=2, batch_size=2).collect()
    assert {tuple(r) for r in rows} == {("a", None, 1, 2, 8, 4, 2), (None, None, 1, 1, 2, 1, 0), (None, None, 3, 3, 10, 5, 2)}
    with pytest.raises(ValueError):
        op.token_cube(df, "n", ["g"], sets=[["other"]])


def test_one_file_has_the_bytes_of_the_shards(spark, tmp_path):
    df = spark.range(3000).select(F.concat(F.lit("Zeile ü "), "id", F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("message"))
    io.write_jsonl(df.repartition(7), str(tmp_path / "shards"))
    io.write_jsonl(df.repartition(7), str(tmp_path / "one.jsonl"), single_file=True)
    parts = sorted(p for p in os.listdir(tmp_path / "shards") if p.startswith("part-"))
    assert (tmp_path / "one.jsonl").read_bytes() == b"".join((tmp_path / "shards" / p).read_bytes() for p in parts)
    assert sorted(os.listdir(tmp_path)) == [".one.jsonl.crc", "one.jsonl", "shards"] or sorted(os.listdir(tmp_path)) == ["one.jsonl", "shards"]


def test_a_store_without_places_is_a_plain_error(spark, tmp_path):
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(str(tmp_path)).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [hadoop.Path(str(tmp_path / n)) for n in "ab"]
    for p in paths:
        fs.create(p).close()
    with pytest.raises(NotImplementedError, match="write shards"):
        lines._concatenate(spark, fs, paths, hadoop.Path(str(tmp_path / "whole")))
