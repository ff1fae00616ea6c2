"""Files out and back: whole, once, and only when the write succeeded."""

import json
import os
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io
from corpusprep.session import SCRATCH_SETTING, drop_scratch, scratch_path
from corpusprep.sources import text_folder

NAMES = ["plain", "sp ace", "per%20cent", "plus+plus", "ünï-🙂", "a/b/last.part", "hash#x", "q?x"]


def corpus(spark, names, text=None):
    rows = [(n, text or f"text of {n}\nline two, é\r\n") for n in names]
    return spark.createDataFrame(rows, "uuid STRING, content STRING")


def siblings(path):
    parent, name = os.path.split(path)
    return [f for f in os.listdir(parent) if f.startswith(name)]


def test_text_folder_roundtrip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = corpus(spark, NAMES)
    manifest = io.write_text_folder(df, "uuid", "content", path)
    assert {r["path"] for r in manifest.collect()} == {f"{path}/{f}" for f in os.listdir(path)}
    got = {r["name"]: r["text"] for r in io.read_text_folder(spark, path).collect()}
    assert got == {n.split("/")[-1].replace(".", "_"): f"text of {n}\nline two, é\r\n" for n in NAMES}
    assert siblings(path) == ["out"]


def test_text_folder_large_text_in_many_partitions(spark, tmp_path):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("uuid"), F.repeat(F.concat(F.lit("x"), "id", F.lit(" ")), 3000).alias("content")
    )
    io.write_text_folder(df.repartition(13), "uuid", "content", str(tmp_path / "out"))
    back = io.read_text_folder(spark, str(tmp_path / "out"))
    assert sorted(back.collect()) == sorted(df.collect())


@pytest.mark.parametrize("names", [["a/x.md", "b/x.md"], ["x.md", "x_md"]])
def test_colliding_names_stop_the_write(spark, tmp_path, names):
    df = corpus(spark, names + ["other"])
    path = str(tmp_path / "out")
    with pytest.raises(io.NameCollision, match="x_md"):
        io.write_text_folder(df, "uuid", "content", path)
    assert siblings(path) == []
    assert [tuple(r) for r in io.export_name_collisions(df, "uuid").collect()] == [("x_md", 2)]
    io.write_text_folder(df, "uuid", "content", path, collisions="suffix")
    assert len(os.listdir(path)) == 3
    with pytest.raises(io.NameCollision):
        io.write_text_folder(corpus(spark, ["same", "same"]), "uuid", "content", path, collisions="suffix")


@pytest.mark.parametrize("name", ["pkg/__init__.py", "dir/", "_hidden", "a:b"])
def test_names_that_cannot_be_read_back(spark, tmp_path, name):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="read back"):
        io.write_text_folder(corpus(spark, [name]), "uuid", "content", path)
    io.write_text_folder(corpus(spark, [name]), "uuid", "content", path, unreadable="keep")
    assert len(os.listdir(path)) == 1


def test_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    io.write_text_folder(corpus(spark, ["a", "b"]), "uuid", "content", path)
    with pytest.raises(Exception, match="exists"):
        io.write_text_folder(corpus(spark, ["c"]), "uuid", "content", path)
    assert sorted(os.listdir(path)) == ["a.txt", "b.txt"]
    io.write_text_folder(corpus(spark, ["c"]), "uuid", "content", path, mode="overwrite")
    assert os.listdir(path) == ["c.txt"] and siblings(path) == ["out"]


def test_null_rows_are_not_written(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, "t"), ("b", "t"), ("b", None)], "id STRING, text STRING")
    io.write_text_folder(df, "id", "text", str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == ["b.txt"]


def test_dropped_rows_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, "t"), ("b", "t")], "id STRING, text STRING")
    counts = Observation("text-folder")
    io.write_text_folder(df, "id", "text", str(tmp_path / "out"), observation=counts)
    assert counts.get == {"in_rows": 3, "dropped_rows": 2}


def test_files_spread_over_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    df = corpus(spark, [f"d{i}" for i in range(60)])
    manifest = {r["name"]: r["path"] for r in io.write_text_folder(df, "uuid", "content", path, spread=True).collect()}
    assert len(os.listdir(path)) > 10 and all(os.path.isfile(p) for p in manifest.values())
    assert {r["name"] for r in io.read_text_folder(spark, path).collect()} == set(manifest)


@pytest.mark.parametrize("partitions", [1, 5])
def test_the_same_error_for_every_partitioning(spark, tmp_path, partitions):
    names = [f"_hidden{i}" for i in range(40)] + ["a/x", "b/x"]
    with pytest.raises(io.NameCollision, match=r"\['x'\]; names that Spark cannot read back, such as \['_hidden0', '_hidden1', '_hidden10'"):
        io.write_text_folder(corpus(spark, names).repartition(partitions), "uuid", "content", str(tmp_path / "out"))


def test_a_failed_replacement_brings_the_old_folder_back(tmp_path, monkeypatch):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "old.txt").write_text("old")
    writer = text_folder._TextFolderWriter(f"file:{tmp_path}/out", overwrite=True)
    writer._remove(writer.stage)  # the folder that commit would move into place
    with pytest.raises(OSError):
        writer.commit([])
    assert (tmp_path / "out" / "old.txt").read_text() == "old"


def test_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    broken = corpus(spark, [f"d{i}" for i in range(40)]).repartition(4)
    broken = broken.withColumn("content", F.when(F.col("uuid") == "d17", F.raise_error(F.lit("bad row"))).otherwise("x"))
    with pytest.raises(Exception, match="bad row"):
        io.write_text_folder(broken, "uuid", "content", path)
    assert siblings(path) == []


def test_task_that_runs_twice_writes_once(tmp_path):
    import pyarrow as pa

    writer = text_folder._TextFolderWriter(f"file:{tmp_path}/out", overwrite=False)
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b"], "text": ["1", "2"]})
    lost = pa.RecordBatch.from_pydict({"name": ["a"], "text": ["1"]})
    writer.write(iter([lost]))  # an attempt whose executor is lost
    done = writer.write(iter([batch]))
    assert not (tmp_path / "out").exists()
    with pytest.raises(RuntimeError, match="elsewhere"):
        writer.commit([text_folder._Done("other")])
    writer.commit([done, None])
    assert {f: (tmp_path / "out" / f).read_text() for f in os.listdir(tmp_path / "out")} == {"a.txt": "1", "b.txt": "2"}
    assert os.listdir(tmp_path) == ["out"]


# --- JSON lines ------------------------------------------------------------------------


def messages(spark, n=50):
    df = spark.range(n).withColumn("prompt", F.concat(F.lit("p \n\"é "), "id")).withColumn("response", F.lit("r"))
    return df.select("id", fn.chat_message("prompt", "response").alias("message"))


def test_split_shards_from_one_pass(spark, tmp_path):
    path = str(tmp_path / "out")
    df = op.split_by_hash(messages(spark), {"train": 0.9, "eval": 0.1}, "id")
    io.write_jsonl(df, path, split_col="split")
    back = io.read_chat_jsonl(spark, path)
    assert back.filter("corrupt is not null or messages is null").count() == 0
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {
        r["split"]: r["count"] for r in df.groupBy("split").count().collect()
    }
    one = io.read_chat_jsonl(spark, f"{path}/split=eval")
    assert {m["role"] for r in one.collect() for m in r["messages"]} == {"system", "user", "assistant"}


def test_single_file(spark, tmp_path):
    path = str(tmp_path / "train.jsonl")
    io.write_jsonl(messages(spark).repartition(5), path, single_file=True)
    with open(path, encoding="utf-8") as f:
        records = [json.loads(line) for line in f.read().split("\n")[:-1]]
    assert len(records) == 50
    with pytest.raises(FileExistsError):
        io.write_jsonl(messages(spark), path, single_file=True)
    io.write_jsonl(messages(spark, 3), path, single_file=True, mode="overwrite")
    assert len(open(path, encoding="utf-8").read().split("\n")) == 4
    assert [f for f in os.listdir(tmp_path) if not f.endswith(".crc")] == ["train.jsonl"]


def test_single_file_of_no_rows(spark, tmp_path):
    io.write_jsonl(messages(spark, 0), str(tmp_path / "none.jsonl"), single_file=True)
    assert (tmp_path / "none.jsonl").read_text() == ""


def test_a_single_file_holds_one_split(spark, tmp_path):
    with pytest.raises(ValueError):
        io.write_jsonl(messages(spark), str(tmp_path / "x"), split_col="id", single_file=True)
    assert os.listdir(tmp_path) == []


def test_corrupt_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"messages": [{"role": "user", "content": null}]}\nnot json\n')
    rows = io.read_chat_jsonl(spark, str(tmp_path / "in.jsonl")).collect()
    assert [r["corrupt"] for r in rows] == [None, "not json"]
    assert rows[0]["messages"][0].asDict() == {"role": "user", "content": None}


def test_packed_splits(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, ["x", "y"]), ("b", 0, ["z", "w"])], "split STRING, sample BIGINT, tokens ARRAY<STRING>")
    io.write_packed(df, str(tmp_path / "p"))
    assert io.read_packed(spark, str(tmp_path / "p")).count() == 2
    assert io.read_packed(spark, str(tmp_path / "p"), "b").first()["tokens"] == ["z", "w"]


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_needs_the_shared_folder_on_a_cluster():
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=uuid.uuid4().hex, _jsc=None))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")
    assert scratch_path(session("local[2]"), "x")
    assert scratch_path(session("spark://host:7077", **{SCRATCH_SETTING: "hdfs://s"}), "x").startswith("hdfs://s/x-")


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    other = scratch_path(spark, "dropped")
    spark.range(3).write.parquet(other)
    drop_scratch(spark, other)
    assert os.path.isdir(path) and not os.path.isdir(other)
    drop_scratch(spark, path, other)
    assert not os.path.isdir(path)


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert io.read_table(spark, "three_rows").count() == 3
