"""Text folders: commit by a manifest, and strict reading of bytes."""

import os
import time

import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from corpusprep import sources as io
from corpusprep.plans import inputs
from corpusprep.sources import text_folder

SCHEMA = "id string, text string"


def read(spark, path):
    return {r["name"]: r["text"] for r in io.read_text_folder(spark, path).collect()}


def test_manifest_round_trip_and_overwrite(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    rows = [(f"a/doc.{i}", f"téxt {i}\r\n") for i in range(30)] + [("x/null", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    listed = io.write_text_folder(df, "id", "text", path, commit="manifest")
    want = {f"doc_{i}": f"téxt {i}\r\n" for i in range(30)}
    assert read(spark, path) == want
    assert {r["name"]: r["path"].rsplit("/", 1)[1] for r in listed.collect()} == {n: f"{n}.txt" for n in want}
    with pytest.raises(Exception, match="exists"):
        io.write_text_folder(df, "id", "text", path, commit="manifest")
    io.write_text_folder(df.limit(0), "id", "text", path, commit="manifest", mode="overwrite")
    assert read(spark, path) == {} and os.listdir(path) == [text_folder.MANIFEST]
    io.write_text_folder(df.filter("id = 'a/doc.7'"), "id", "text", path, commit="manifest", mode="overwrite")
    assert read(spark, path) == {"doc_7": "téxt 7\r\n"}
    for bad in ({"commit": "other"}, {"commit": "manifest", "spread": True}):
        with pytest.raises(ValueError):
            io.write_text_folder(df, "id", "text", path, mode="overwrite", **bad)


def test_two_attempts_of_a_task_leave_one_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_folder, "FILES_PER_FOLDER", 4)
    path = f"file:{tmp_path}/out"
    batch = pa.RecordBatch.from_pydict({"name": [f"n{i}" for i in range(10)], "text": [f"t{i}" for i in range(10)]})
    os.makedirs(tmp_path / "out")
    first = [f for b in text_folder._write_parts(path)(iter([batch])) for f in b["folder"].to_pylist()]
    assert len(first) == 3
    df = spark.createDataFrame(batch.to_pylist(), "name string, text string")
    text_folder._write_with_manifest(df, path, overwrite=True)
    assert read(spark, path) == {f"n{i}": f"t{i}" for i in range(10)}
    listed = text_folder._listed_folders(path)
    assert not set(first) & set(listed) and set(first) < set(os.listdir(tmp_path / "out"))


def test_a_task_that_fails_halfway(spark, tmp_path):
    def half_then_fail(batches):
        for batch in batches:
            yield batch.slice(0, 5)
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost on purpose")
            yield batch.slice(5)

    df = spark.range(40).selectExpr("cast(id as string) as id", "concat('t', id) as text").repartition(3)
    io.write_text_folder(df.mapInArrow(half_then_fail, SCHEMA), "id", "text", str(tmp_path / "out"), commit="manifest")
    assert read(spark, str(tmp_path / "out")) == {str(i): f"t{i}" for i in range(40)}


def test_a_failed_overwrite_leaves_the_old_texts(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("1", "old")], SCHEMA)
    io.write_text_folder(df, "id", "text", path, commit="manifest")
    broken = df.withColumn("text", F.when(F.col("id") == "1", F.raise_error(F.lit("on purpose"))).otherwise("new"))
    with pytest.raises(Exception, match="on purpose"):
        io.write_text_folder(broken, "id", "text", path, commit="manifest", mode="overwrite")
    assert read(spark, path) == {"1": "old"}


FILES = {
    "good": b"gr\xc3\xbc\xc3\x9fe \xf0\x9f\x99\x82\r\n",
    "empty": b"",
    "latin": b"gr\xfc\xdfe",
    "cut": b"ok \xe2\x82",
    "own": "a � b".encode(),
    "own_then_bad": "a � b�".encode() + b"\xff tail",
    "surrogate": b"x\xed\xa0\x80y",
    "long": b"overlong \xc0\xaf",
    "nul": b"a\x00b",
}


def first_bad(data):
    try:
        data.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start


def test_strict_reading_reports_bytes_that_are_no_utf8(spark, tmp_path):
    for name, data in FILES.items():
        (tmp_path / f"{name}.txt").write_bytes(data)
    (tmp_path / "other.bin").write_bytes(b"\xff")
    rows = {r["name"]: r for r in io.read_text_folder(spark, str(tmp_path), strict=True).collect()}
    filled = {name: data for name, data in FILES.items() if data}
    assert set(rows) == set(filled)
    for name, data in filled.items():
        bad = first_bad(data)
        assert rows[name]["text"] == (data.decode() if bad is None else None)
        assert rows[name]["fault"] == (None if bad is None else f"not UTF-8 from byte {bad}"), name
    loose = read(spark, str(tmp_path))
    assert {n: loose[n] for n in ("good", "own", "nul")} == {n: FILES[n].decode() for n in ("good", "own", "nul")}
    assert "�" in loose["latin"]


def test_small_files_share_a_task(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    assert io.read_text_folder(spark, str(tmp_path), strict=True).rdd.getNumPartitions() <= 16


def test_export_takes_no_longer_than_row_by_row(spark, tmp_path):
    corpus = inputs.documents(spark, "/root/testdata/sf0.1").withColumn("id", F.col("doc_id").cast("string"))
    out = str(tmp_path)

    def ours(i):
        io.write_text_folder(corpus, "id", "text", f"{out}/ours{i}", commit="manifest")

    def theirs(i):
        os.makedirs(f"{out}/theirs{i}")

        @F.udf("string")
        def save(name, text):
            with open(f"{out}/theirs{i}/{name}.txt", "w") as f:
                f.write(text)
            return name

        corpus.select(save("id", "text")).write.format("noop").mode("overwrite").save()

    def seconds(job):
        taken = []
        for i in range(3):
            start = time.perf_counter()
            job(i)
            taken.append(time.perf_counter() - start)
        return min(taken)

    print("manifest", seconds(ours), "row by row", seconds(theirs))
    assert len(read(spark, f"{out}/ours0")) == 10000


@pytest.mark.parametrize("commit", ["move", "manifest"])
def test_a_task_reads_many_small_files(spark, tmp_path, commit):
    path = str(tmp_path / "out")
    rows = [(f"a/doc.{i}", f"téxt {i}") for i in range(400)]
    io.write_text_folder(spark.createDataFrame(rows, SCHEMA).repartition(4), "id", "text", path, commit=commit)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # by Spark's count of a file's cost: one each
    try:
        back = io.read_text_folder(spark, path)
        assert back.rdd.getNumPartitions() <= 8
        assert {r["name"]: r["text"] for r in back.collect()} == {f"doc_{i}": f"téxt {i}" for i in range(400)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
