"""Binary sample shards: index, random access, commit by manifest, retries, window shuffle."""

import hashlib
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from corpusprep import sources as io
from corpusprep.sources import shards


def samples(spark, n=230, kind="int"):
    token = {"int": "cast(id * 3 + i as int)", "bigint": "id * 10000000000 + i", "string": "concat('wörd', id, i)"}[kind]
    tokens = F.expr(f"transform(sequence(0, cast(id % 5 as int)), i -> {token})")
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "val").otherwise("train").alias("split"), F.col("id").alias("sample"), tokens.alias("tokens")).repartition(5)


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_round_trip_and_random_access(spark, tmp_path, kind):
    df, path = samples(spark, kind=kind), str(tmp_path / "out")
    io.write_shards(df, path, split_col="split", shard_samples=16)
    back = io.read_shards(spark, path)
    assert back.schema["tokens"].dataType.simpleString() == f"array<{kind}>"
    rows = {r["sample"]: (r["split"], r["tokens"]) for r in df.collect()}
    assert {r["sample"]: (r["split"], r["tokens"]) for r in back.collect()} == rows
    assert {r["sample"] for r in io.read_shards(spark, path, "val").collect()} == set(range(0, 230, 3))
    some = io.read_shards(spark, path, numbers=[3, 4, 200, 200, 10_000, -1])
    assert {r["sample"]: (r["split"], r["tokens"]) for r in some.collect()} == {k: rows[k] for k in (3, 4, 200)}
    assert some.rdd.getNumPartitions() == 4  # shards that may hold one: 0 of both splits, 12 of both
    local = io.SampleShards(path, "train")
    assert len(local) == sum(s == "train" for s, _ in rows.values())
    assert [list(local[k]) for k in (1, 229, 100)] == [rows[k][1] for k in (1, 229, 100)]
    for missing in (0, 230, -5):
        with pytest.raises(IndexError):
            local[missing]


def test_a_sample_is_read_alone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    io.write_shards(spark.range(64).selectExpr("id as sample", "array_repeat(7, 10000) as tokens"), path, shard_samples=64)
    read = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def read_at(self, n, at):
            read.append(n)
            return self.file.read_at(n, at)

    plain = shards.Shard.__init__

    def counting(self, *args):
        plain(self, *args)
        self.file = Counted(self.file)

    monkeypatch.setattr(shards.Shard, "__init__", counting)
    assert np.array_equal(io.SampleShards(path)[40], np.full(10000, 7))
    assert read == [40_000]


def test_bounded_shards_and_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark), path, split_col="split", shard_samples=16)
    listed = shards._manifest(f"file:{path}").to_pylist()
    assert all(r["last"] // 16 == r["first"] // 16 == r["shard"] and r["samples"] <= 16 for r in listed)
    assert sum(r["samples"] for r in listed) == 230
    assert all(os.path.getsize(f"{path}/{r['file']}") == r["bytes"] for r in listed)
    files = {f"{os.path.relpath(d, path)}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".bin")}
    assert files == {r["file"] for r in listed}


def test_overwrite_and_errors(spark, tmp_path):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark, 30), path)
    with pytest.raises(Exception, match="holds samples"):
        io.write_shards(samples(spark, 10), path)
    # A write that fails leaves what was there.
    twice = samples(spark, 10).union(samples(spark, 10))
    with pytest.raises(Exception, match="twice"):
        io.write_shards(twice, path, mode="overwrite")
    assert io.read_shards(spark, path).count() == 30
    io.write_shards(samples(spark, 10), path, mode="overwrite")
    assert sorted(r["sample"] for r in io.read_shards(spark, path).collect()) == list(range(10))
    # What the failed write left is in no manifest.
    assert io.drop_unlisted(path) > 0 and io.drop_unlisted(path) == 0
    assert sum(f.endswith(".bin") for _, _, names in os.walk(path) for f in names) == 1
    assert io.read_shards(spark, path).count() == 10
    with pytest.raises(TypeError):
        io.write_shards(samples(spark, 3).withColumn("tokens", F.array(F.lit(1.5))), path, mode="overwrite")
    with pytest.raises(Exception, match="no number"):
        io.write_shards(samples(spark, 3).withColumn("sample", F.lit(None).cast("long")), path, mode="overwrite")


def test_empty_table_and_empty_samples(spark, tmp_path):
    io.write_shards(samples(spark, 0), str(tmp_path / "none"))
    assert io.read_shards(spark, str(tmp_path / "none")).collect() == []
    assert io.shuffled_shards(spark, str(tmp_path / "none")).collect() == []
    df = spark.createDataFrame([(0, []), (1, None), (2, [5])], "sample long, tokens array<int>")
    io.write_shards(df, str(tmp_path / "few"))
    assert sorted((r["sample"], r["tokens"]) for r in io.read_shards(spark, str(tmp_path / "few")).collect()) == [(0, []), (1, []), (2, [5])]


def test_a_task_that_fails_halfway_leaves_one_of_each(spark, tmp_path):
    df = samples(spark).coalesce(1).sortWithinPartitions("split", "sample")

    def half_then_fail(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 40):
                if i > 80 and TaskContext.get().attemptNumber() == 0:
                    raise RuntimeError("lost on purpose")
                yield batch.slice(i, 40)

    path = str(tmp_path / "out")
    flaky = df.mapInArrow(half_then_fail, df.schema)
    # Straight into the writer, so that it has written shards when the task fails.
    spark.dataSource.register(shards.SampleShardSource)
    rows = flaky.select("split", shards.shard_of("sample", 16).alias("shard"), "sample", "tokens")
    rows.write.format("sampleshards").option("kind", "int").mode("append").save(f"file:{path}")
    assert sorted(r["sample"] for r in io.read_shards(spark, path).collect()) == list(range(230))


def test_a_task_that_runs_twice_leaves_one_of_each(spark, tmp_path):
    rows = samples(spark, 50).sort("sample").select(F.lit("a/b").alias("split"), shards.shard_of("sample", 16).alias("shard"), "sample", "tokens")
    batches = rows.toArrow().to_batches()
    path = f"file:{tmp_path}/out"
    writer = shards._ShardWriter(path, overwrite=False, kind="int")
    first, second = writer.write(iter(batches)), writer.write(iter(batches))
    with pytest.raises(RuntimeError, match="two tasks"):
        writer.commit([first, second])
    writer.commit([second, None])
    assert sorted(r["sample"] for r in io.read_shards(spark, path, "a/b").collect()) == list(range(50))
    assert io.drop_unlisted(path) == len(first.shards) == 4
    writer.abort([second])
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".bin")]


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("window", [1, 3, 100])
def test_window_shuffle(spark, tmp_path, window):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark, 200).drop("split"), path, shard_samples=16)
    rows = io.shuffled_shards(spark, path, seed=5, window=window).collect()
    order = sorted(range(13), key=lambda s: digest(f"5:shard:{s}"))
    want = []
    for i in range(0, 13, window):
        inside = [n for s in order[i : i + window] for n in range(16 * s, min(200, 16 * s + 16))]
        want += sorted(inside, key=lambda n: digest(f"5:{n}"))
    assert [r["sample"] for r in sorted(rows, key=lambda r: r["position"])] == want
    assert [r["position"] for r in rows] == list(range(200))  # partitions follow the order
    spread = io.shuffle_spread(spark.createDataFrame(rows)).first()
    assert spread["n_samples"] == 200 and 0.5 < spread["moved"] < 1.5
    plain = io.shuffle_spread(spark.range(50).selectExpr("id as sample", "id as position")).first()
    assert (plain["moved"], plain["kept_next"]) == (0.0, 49)


def test_a_task_reads_many_small_shards(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark, 230), path, split_col="split", shard_samples=1)
    back = io.read_shards(spark, path)
    assert back.rdd.getNumPartitions() <= 2 * 8 + 1  # of 230 shards, on eight cores
    assert sorted(r["sample"] for r in back.collect()) == list(range(230))
    reader = shards._ShardReader({"path": f"file:{path}", "tasks": "1"})
    monkeypatch.setattr(shards, "BYTES_OF_TASK", 1000)
    parts = reader.partitions()
    sizes = [sum(r["bytes"] for rows, _ in p.windows for r in rows) for p in parts]
    assert len(parts) > 8 and max(sizes) <= 1000 and sum(len(p.windows) for p in parts) == 230


def test_a_task_reads_many_windows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark, 230, "string").drop("split"), path, shard_samples=2)
    monkeypatch.setattr(shards, "ROWS_AT_ONCE", 3)
    rows = io.shuffled_shards(spark, path, seed=5, window=2)
    assert rows.rdd.getNumPartitions() <= 2 * 8 + 1  # of 58 windows
    rows = rows.collect()
    assert [r["position"] for r in rows] == list(range(230))
    tokens = {r["sample"]: r["tokens"] for r in samples(spark, 230, "string").collect()}
    assert {r["sample"]: r["tokens"] for r in rows} == tokens


def test_without_tokens_only_the_index_is_read(spark, tmp_path):
    path = str(tmp_path / "out")
    io.write_shards(samples(spark, 40, "string").drop("split"), path, shard_samples=16)
    whole = io.shuffled_shards(spark, path, window=2).drop("tokens")
    for file in (tmp_path / "out").rglob("*.bin"):  # the index holds, the payloads do not
        data = file.read_bytes()
        n = int.from_bytes(data[-16:-8], "little")
        tail = 8 * (2 * n + 2) + 8
        file.write_bytes(bytes(len(data) - tail) + data[-tail:])
    index = io.shuffled_shards(spark, path, window=2, tokens=False)
    assert index.columns == ["split", "sample", "position"]
    assert index.collect() == whole.collect() and index.count() == 40


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_payloads_of_a_batch_and_back(kind):
    lists = [[], [1, 2], [3], [], [4, 5, 6]]
    lists = [[f"wörd{x}" * (x % 3) for x in some] for some in lists] if kind == "string" else lists
    whole = pa.array([[*lists[1]], *lists, [*lists[2]]], pa.list_(shards.KINDS[kind][1]))
    payloads = list(shards._packed(kind, whole.slice(1, 5)))
    assert [list(shards._unpack(kind, p)) for p in payloads] == lists
    assert shards._unpacked(kind, [memoryview(p) for p in payloads]).to_pylist() == lists
    assert list(shards._packed(kind, whole.slice(0, 0))) == [] and len(list(shards._packed(kind, whole.slice(1, 1)))) == 1
    with pytest.raises(ValueError, match="null token"):
        list(shards._packed(kind, pa.array([[None]], pa.list_(shards.KINDS[kind][1]))))
