"""Tasks that fail halfway and run again leave whole, unchanged results."""

import os

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(6, "doc_id")


@pytest.fixture(scope="module")
def flaky(documents):
    def half_then_fail(batches):
        task = TaskContext.get()
        for batch in batches:
            half = len(batch) // 2
            yield batch[:half]
            if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
                raise RuntimeError("lost on purpose")
            yield batch[half:]

    return documents.mapInPandas(half_then_fail, "doc_id long, text string")


def test_packing(documents, flaky):
    whole = op.pack_tokens(documents, fn.whitespace_tokens("text"), "doc_id", length=256).collect()
    again = op.pack_tokens(flaky, fn.whitespace_tokens("text"), "doc_id", length=256).collect()
    assert sorted(again) == sorted(whole)


def test_shuffled_positions(documents, flaky):
    whole = op.shuffle_rows(documents.select("doc_id"), "doc_id").collect()
    assert sorted(op.shuffle_rows(flaky.select("doc_id"), "doc_id").collect()) == sorted(whole)


def test_text_folder(spark, documents, flaky, tmp_path):
    as_text = F.col("doc_id").cast("string").alias("name")
    io.write_text_folder(flaky.select(as_text, "text"), "name", "text", str(tmp_path / "out"))
    back = io.read_text_folder(spark, str(tmp_path / "out"))
    assert sorted(back.collect()) == sorted(documents.select(as_text, "text").collect())
    assert os.listdir(tmp_path) == ["out"]


def test_single_file(flaky, tmp_path):
    lines = flaky.select(fn.pair_json(F.col("doc_id").cast("string"), "text").alias("message"))
    io.write_jsonl(lines, str(tmp_path / "all.jsonl"), single_file=True)
    with open(tmp_path / "all.jsonl", encoding="utf-8") as f:
        assert len(f.read().split("\n")) == 1001
