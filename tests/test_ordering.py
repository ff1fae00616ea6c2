"""Running sums, positions, packing, batches, budgets and run views against
plain Python, with hot groups and uneven input."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep.operators import ordering


def table(spark, rows, schema, partitions=4):
    return spark.createDataFrame(rows, schema).repartition(partitions)


def skewed_rows(n=3000, seed=3):
    """A third of the rows in group 'hot'; keys with gaps; uneven values."""
    rng = random.Random(seed)
    keys = rng.sample(range(10**9), n)
    groups = ["hot" if i % 3 == 0 else f"g{rng.randrange(200)}" for i in range(n)]
    return [(g, k, rng.choice([0, 1, 1, 2, 5000])) for g, k in zip(groups, keys)]


def expected_starts(rows):
    total, out = {}, {}
    for g, k, v in sorted(rows):
        out[(g, k)] = total.get(g, 0)
        total[g] = total.get(g, 0) + v
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_start_by_group(spark, partitions):
    rows = skewed_rows()
    df = table(spark, rows, "g STRING, k BIGINT, v BIGINT", partitions)
    got = op.running_start(df, F.col("v"), "k", "g").collect()
    assert {(r["g"], r["k"]): r["start"] for r in got} == expected_starts(rows)


@pytest.mark.parametrize("key", ["cast(k as string)", "cast(k as double)", "timestamp_micros(k)", "date_add(date'2000-01-01', int(k % 9000))"])
def test_position_by_other_key_types(spark, key):
    rows = skewed_rows(900)
    df = table(spark, rows, "g STRING, k BIGINT, v BIGINT").withColumn("key", F.expr(key)).dropDuplicates(["key"])
    got = op.with_position(df, "key").collect()
    assert [r["position"] for r in sorted(got, key=lambda r: r["key"])] == list(range(len(got)))


def test_null_keys_come_first(spark):
    df = table(spark, [(i if i else None,) for i in range(600)], "k INT")
    got = {r["k"]: r["position"] for r in op.with_position(df, "k").collect()}
    assert got[None] == 0 and got[599] == 599


def test_null_group_is_a_group(spark):
    rows = [(None if g == "hot" else g, k, v) for g, k, v in skewed_rows(900)]
    df = table(spark, rows, "g STRING, k BIGINT, v BIGINT")
    got = op.running_start(df, F.col("v"), "k", "g").collect()
    expected = expected_starts([(g or "", k, v) for g, k, v in rows])
    assert {(r["g"] or "", r["k"]): r["start"] for r in got} == expected


def test_any_bounds_give_the_same_result(spark, monkeypatch):
    rows = skewed_rows(1000)
    df = table(spark, rows, "g STRING, k BIGINT, v BIGINT")
    for per_bucket, fan_out in ((2, 2), (1, 3), (10, 16)):
        monkeypatch.setattr(ordering, "SAMPLES_PER_BUCKET", per_bucket)
        monkeypatch.setattr(ordering, "FAN_OUT", fan_out)
        monkeypatch.setattr(ordering, "MIN_ROWS_PER_BUCKET", 5)
        got = op.running_start(df, F.col("v"), "k", "g").collect()
        assert {(r["g"], r["k"]): r["start"] for r in got} == expected_starts(rows)


def test_hot_group_is_spread_over_buckets(spark):
    df = table(spark, skewed_rows(6000), "g STRING, k BIGINT, v BIGINT")
    sizes = df.groupBy(op.range_bucket(df, ["g", "k"], buckets=32).alias("b")).count().collect()
    assert len(sizes) >= 24
    assert max(r["count"] for r in sizes) < 6000 / 32 * 3


def test_ties_stop_the_job(spark):
    df = table(spark, [(i // 2,) for i in range(400)], "k INT")
    with pytest.raises(Exception, match="does not tell all rows apart"):
        op.with_position(df, "k").collect()


@pytest.mark.parametrize("columns", [["k"], ["j", "k"]])
def test_null_keys_that_tie_stop_the_job(spark, columns):
    df = table(spark, [(1, None), (1, None), (1, 3)], "j INT, k INT")
    with pytest.raises(Exception, match="does not tell all rows apart"):
        op.with_position(df, columns).collect()
    with pytest.raises(Exception, match="tell all rows apart|follow on each other"):
        op.pack_tokens(df.withColumn("text", F.lit("a b c")), fn.whitespace_tokens("text"), columns, 4).collect()


def test_names_with_blanks_and_long_keys(spark):
    df = table(spark, [("x" * 500 + str(i), i) for i in range(1000, 1600)], "`run name` STRING, `order id` INT")
    assert op.with_position(df, "order id", "run name").filter("position > 0").count() == 0
    placed = op.with_position(df, "run name").collect()
    assert {r["run name"][-4:]: r["position"] for r in placed} == {str(i): i - 1000 for i in range(1000, 1600)}
    assert max(len(str(b)) for b in ordering.range_bounds(df, ["run name"], 8)) <= ordering.KEY_CHARS
    with pytest.raises(ValueError, match="buckets"):
        ordering.range_bounds(df, ["run name"], 10**6)


def test_totals_by_group(spark):
    rows = skewed_rows(3000)
    df = table(spark, rows, "g STRING, k BIGINT, v BIGINT")
    got = {(r["g"], r["n"]) for r in op.with_position(df, "k", "g", total="n").collect()}
    assert got == set(Counter(g for g, _, _ in rows).items())


def test_empty_table(spark):
    df = spark.createDataFrame([], "k INT, text STRING")
    assert op.with_position(df, "k").collect() == []
    assert op.pack_tokens(df, fn.whitespace_tokens("text"), "k").collect() == []
    assert op.take_token_budget(df.withColumn("n", F.lit(1)), "n", "k", 5).collect() == []


# --- packing ---------------------------------------------------------------------


def packed_by_hand(docs, length, eos, drop_tail):
    stream = []
    for _, text in sorted(docs):
        stream += (text or "").split() if text is not None else []
        if eos is not None and text is not None:
            stream.append(eos)
    cut = [stream[i : i + length] for i in range(0, len(stream), length)]
    return [s for s in cut if len(s) == length] if drop_tail else cut


EDGE_DOCS = [(1, ""), (2, "a b c"), (3, " ".join(f"w{i}" for i in range(17))), (4, "x"), (5, None), (6, "y z")]


@pytest.mark.parametrize("length", [1, 4, 5, 100])
@pytest.mark.parametrize("eos", ["<|endoftext|>", None])
@pytest.mark.parametrize("drop_tail", [True, False])
def test_pack_edges(spark, length, eos, drop_tail):
    df = table(spark, EDGE_DOCS, "doc_id BIGINT, text STRING")
    got = op.pack_tokens(df, fn.whitespace_tokens("text"), "doc_id", length, eos, drop_tail=drop_tail)
    rows = got.orderBy("sample").collect()
    assert [r["tokens"] for r in rows] == packed_by_hand(EDGE_DOCS, length, eos, drop_tail)
    assert [r["sample"] for r in rows] == list(range(len(rows)))


def test_pack_keeps_all_tokens_in_order_with_one_huge_document(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(f"t{k}_{i}" for i in range(rng.randrange(40)))) for k in rng.sample(range(10**6), 500)]
    docs.append((500_001, " ".join(f"big{i}" for i in range(8000))))
    docs = list(dict(docs).items())
    df = table(spark, docs, "doc_id BIGINT, text STRING", 5)
    got = op.pack_tokens(df, fn.whitespace_tokens("text"), "doc_id", 64, drop_tail=False).orderBy("sample").collect()
    assert [r["tokens"] for r in got] == packed_by_hand(docs, 64, fn.DEFAULT_EOS, False)


def test_pack_token_ids_by_group(spark):
    docs = [("a", 1, [1, 2, 3]), ("b", 2, [4]), ("a", 3, [5, 6])]
    df = table(spark, docs, "split STRING, id INT, ids ARRAY<INT>")
    got = op.pack_tokens(df, F.col("ids"), "id", 2, eos=0, group_by="split", drop_tail=False)
    rows = {(r["split"], r["sample"]): r["tokens"] for r in got.collect()}
    assert rows == {("a", 0): [1, 2], ("a", 1): [3, 0], ("a", 2): [5, 6], ("a", 3): [0], ("b", 0): [4, 0]}


def test_file_tokenizer_ids_can_be_packed(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    words = {"[UNK]": 0, "a": 1, "b": 2, "c": 3, "</s>": 4}
    tok = tokenizers.Tokenizer(tokenizers.models.WordLevel(words, unk_token="[UNK]"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    path = str(tmp_path / "tokenizer.json")
    tok.save(path)
    encode = fn.file_tokenizer(spark, path)
    df = table(spark, [(1, "a b"), (2, None), (3, "c q")], "id INT, text STRING")
    ids = {r["id"]: r["ids"] for r in df.withColumn("ids", encode("text")).collect()}
    assert ids == {1: [1, 2], 2: None, 3: [3, 0]}
    packed = op.pack_tokens(df, encode("text"), "id", 3, eos=4).collect()
    assert sorted(r["tokens"] for r in packed) == [[1, 2, 4], [3, 0, 4]]


# --- shuffle, batches, budgets --------------------------------------------------------


def test_shuffle_is_a_permutation_that_ignores_partitioning(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold"))
    first = {r["id"]: r["position"] for r in op.shuffle_rows(df.repartition(3), "id").collect()}
    again = {r["id"]: r["position"] for r in op.shuffle_rows(df.repartition(7), "id").collect()}
    other = {r["id"]: r["position"] for r in op.shuffle_rows(df, "id", seed=18).collect()}
    assert first == again != other
    assert sorted(first.values()) == list(range(1000))
    grouped = op.shuffle_rows(df, "id", group_by="g").collect()
    assert sorted(r["position"] for r in grouped if r["g"] == "hot") == list(range(334))


def test_batches(spark):
    placed = op.with_position(spark.range(100, 350), "id")
    kept = op.assign_batches(placed, 100).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in kept} == {0: 100, 1: 100, 2: 50}
    full = op.assign_batches(placed, 100, drop_last=True)
    assert {r["batch"] for r in full.collect()} == {0, 1}
    assert op.eval_subset(full, 1).count() == 100
    assert op.eval_subset(full, -1).count() == 200


def test_short_last_batch_of_each_group(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 90, "a").when(F.col("id") < 95, "b"))
    counted = op.with_position(df, "id", "g", total="n")
    for full in (
        op.assign_batches(counted, 64, drop_last=True, total="n"),
        op.assign_batches(counted, 64, drop_last=True, group_by="g"),
    ):
        assert [tuple(r) for r in full.groupBy("g", "batch").count().collect()] == [("a", 0, 64)]


def test_part_files_are_the_shuffle(spark, tmp_path):
    df = spark.range(3000).withColumn("text", F.repeat(F.col("id").cast("string"), 5))
    shuffled = op.shuffle_into_order(df, "id", partitions=6, total="n")
    shuffled.write.parquet(str(tmp_path / "out"))
    files = sorted(f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-"))
    import pyarrow.parquet as pq

    rows = [r for f in files for r in pq.read_table(f).to_pylist()]
    assert [r["position"] for r in rows] == list(range(3000)) and {r["n"] for r in rows} == {3000}
    same = {r["id"]: r["position"] for r in op.shuffle_rows(df.repartition(7), "id").collect()}
    assert {r["id"]: r["position"] for r in rows} == same
    plan = shuffled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("budget", [0, 1, 777, 10**4, 10**6, 3 * 10**6])
@pytest.mark.parametrize("key", ["bigint", "string"])
def test_token_budget(spark, budget, key):
    rows = [(k if key == "bigint" else f"k{k}", v) for _, k, v in skewed_rows(800)]
    rows.append((None, 3))
    df = table(spark, rows, f"k {key}, n BIGINT")
    kept, so_far, epoch = [], 0, 0
    while so_far < budget:
        for k, n in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
            if so_far < budget:
                kept.append((k, epoch))
            so_far += n
        epoch += 1
    got = [(r["k"], r["epoch"]) for r in op.take_duration(df, f"{budget}tok", "n", "k").collect()]
    assert Counter(got) == Counter(kept)


def test_token_budget_over_several_keys(spark):
    rows = skewed_rows(500)
    df = table(spark, rows, "g STRING, k BIGINT, n BIGINT")
    kept, so_far = set(), 0
    for g, k, n in sorted(rows):
        if so_far < 20_000:
            kept.add((g, k))
        so_far += n
    assert {(r["g"], r["k"]) for r in op.take_token_budget(df, "n", ["g", "k"], 20_000).collect()} == kept


def test_epochs_and_durations(spark):
    df = spark.range(5)
    rows = op.take_duration(df, "3ep", "id", "id").collect()
    assert sorted((r["id"], r["epoch"]) for r in rows) == [(i, e) for i in range(5) for e in range(3)]
    assert {r["epoch"] for r in op.take_duration(df.withColumn("n", F.lit(1)), "3tok", "n", "id").collect()} == {0}
    # Two batches of three samples of two tokens are twelve tokens: two passes and two.
    long = op.take_duration(df.withColumn("n", F.lit(1)), "2ba", "n", "id", batch_size=3, length=2).collect()
    assert sorted((r["epoch"], r["id"]) for r in long) == [(e, i) for e in (0, 1) for i in range(5)] + [(2, 0), (2, 1)]
    for bad in ("10", "ep", "0ep", "-1tok", "5bat"):
        with pytest.raises(ValueError):
            op.take_duration(df, bad, "id", "id")


def test_token_report(spark):
    df = spark.createDataFrame([("en", 10), ("en", 15), ("fr", 3)], "lang STRING, n BIGINT")
    got = {r["lang"]: tuple(r)[1:] for r in op.token_report(df, "n", "lang", length=4, batch_size=2).collect()}
    assert got == {"en": (2, 25, 6, 3), "fr": (1, 3, 0, 0)}


# --- runs --------------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_block", [3, 10, 100_000])
def test_rolling_mean_across_blocks(spark, rows_per_block):
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"r{i % 40}", i, float(rng.randrange(100))) for i in range(900)]
    df = table(spark, rows, "run STRING, seq INT, value DOUBLE")
    got = op.rolling_mean(df, "run", "seq", "value", n=3, rows_per_block=rows_per_block).collect()
    history, expected = {}, {}
    for run, seq, value in rows:
        history.setdefault(run, []).append(value)
        last = history[run][-3:]
        expected[seq] = sum(last) / len(last)
    assert len(got) == 900
    assert {r["seq"]: r["rolling_mean"] for r in got} == pytest.approx(expected)


def test_every_nth_and_timeline(spark):
    rows = [("hot" if i % 3 else f"r{i % 5}", i) for i in range(700)]
    df = table(spark, rows, "run STRING, seq INT")
    seen, expected = {}, set()
    for run, seq in rows:
        seen.setdefault(run, []).append(seq)
        if len(seen[run]) % 7 == 0:
            expected.add((run, seq, len(seen[run])))
    assert {tuple(r) for r in op.every_nth(df, 7, "run", "seq").collect()} == expected
    one = op.run_timeline(df, "run", "seq", run="hot").orderBy("position").collect()
    assert [r["seq"] for r in one] == seen["hot"]


# --- splits ---------------------------------------------------------------------------


def test_hash_split_is_stable_and_complete(spark):
    weights = {"train": 8, "val": 1, "test": 1}
    df = spark.range(1000)
    first = {r["id"]: r["split"] for r in op.split_by_hash(df.repartition(1), weights, "id").collect()}
    for n in (4, 7):
        assert first == {r["id"]: r["split"] for r in op.split_by_hash(df.repartition(n), weights, "id").collect()}
    sizes = {s: list(first.values()).count(s) for s in weights}
    assert sum(sizes.values()) == 1000 and 740 < sizes["train"] < 860
    assert first != {r["id"]: r["split"] for r in op.split_by_hash(df, weights, "id", seed=1).collect()}
    with pytest.raises(ValueError):
        op.split_label({}, "id")


def test_small_splits_get_their_rows(spark):
    df = spark.range(200_000)
    sizes = {r["split"]: r["count"] for r in op.split_by_hash(df, {"train": 0.9999, "eval": 0.0001}, "id").groupBy("split").count().collect()}
    assert 8 <= sizes["eval"] <= 36 and sum(sizes.values()) == 200_000
    with pytest.raises(ValueError, match="too small"):
        op.split_label({"train": 1.0, "eval": 1e-11}, "id")
    assert op.split_bounds({"a": 1, "none": 0, "b": 1, "also none": 0}) == [("a", 1 << 31), ("none", 1 << 31), ("b", 1 << 32), ("also none", 1 << 32)]


def test_copies_stay_on_one_side_when_split_by_text(spark):
    df = spark.range(300).withColumn("text", F.concat(F.lit("t"), F.col("id") % 50))
    sides = op.split_by_hash(df, {"a": 0.5, "b": 0.5}, "text").groupBy("text").agg(F.countDistinct("split").alias("n"))
    assert sides.agg(F.max("n")).first()[0] == 1
