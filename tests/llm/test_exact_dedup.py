"""The extendible-hash index: batches, collisions, splits, ties."""

from collections import Counter, defaultdict
from hashlib import sha256

import brute
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import exact_dedup
from corpusprep.session import scratch_path

SCHEMA = "doc_id long, text string"


def plain(docs):
    """keep_id, group_size and digest per row; rows of one key may share them."""
    groups = defaultdict(list)
    body = lambda t: brute.re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for key, text in docs:
        groups[body(text)].append(key)
    least = lambda keys: min((k for k in keys if k is not None), default=None)
    return Counter((k, least(groups[body(t)]), len(groups[body(t)]), sha256(body(t).encode()).hexdigest()) for k, t in docs)


def facts(rows):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows)


@pytest.mark.parametrize("seed", [1])
@pytest.mark.parametrize("bits", [1, 64])
def test_batches_against_brute_force(spark, seed, bits):
    docs = brute.corpus(seed, 120)
    index = exact_dedup.ExactIndex(spark, scratch_path(spark, "index"), hash_bits=bits, bucket_bytes=3000)
    seen = []
    for part in (docs[:50], docs[50:90], docs[90:]):
        rows = exact_dedup.mark_copies(spark.createDataFrame(part, SCHEMA).repartition(3), index=index).collect()
        seen += part
        want = plain(seen)
        assert all(want[f] for f in facts(rows)) and len(rows) == len(part)
        # Opened again, the index is what the files say.
        again = exact_dedup.ExactIndex(spark, index.path)
        assert again.generation == index.generation and sorted(again.buckets, key=str) == sorted(index.buckets, key=str)
    assert len(index.buckets) > 1 and index.entries().agg(F.sum("n")).first()[0] == 120
    assert index.entries().count() == len({f[3] for f in plain(docs)})
    if bits == 1:  # two hashes: what cannot split is chained
        assert sum(b.entries > 0 for b in index.buckets) == 2
    else:
        assert all(b.bytes <= 3000 or b.entries <= 2 for b in index.buckets)


def test_buckets_cover_all_hashes():
    buckets = [exact_dedup.Bucket(0, 1), exact_dedup.Bucket(2, 2), *exact_dedup.split(exact_dedup.Bucket(3, 2), 2)]
    table, depth = exact_dedup.pointers(buckets)
    assert depth == 4 and table.tolist() == [0] * 8 + [1] * 4 + [2, 3, 4, 5]


def test_ties_and_nulls_keep_one_row(spark):
    docs = [(None, "a  b"), (None, "a b"), (None, "a\tb"), (5, "x"), (5, "x"), (5, " x"), (7, None), (8, ""), (9, " ")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4).withColumn("hash", F.lit("clash")).withColumn("n", F.lit(1))
    rows = exact_dedup.mark_copies(df).collect()
    assert facts(rows) == plain(docs)
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in rows})
    assert exact_dedup.mark_copies(df.limit(0)).collect() == []


def test_a_third_of_the_rows_is_one_text(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 1, "hot  text").otherwise(F.concat(F.lit("t "), F.col("id").cast("string"))).alias("text"))
    rows = exact_dedup.mark_copies(df).groupBy("group_size", "kept").count().collect()
    assert {(r[0], r[1], r[2]) for r in rows} == {(1, True, 6000), (3000, True, 1), (3000, False, 2999)}


def test_an_unfinished_batch_does_not_count(spark):
    path = scratch_path(spark, "index")
    index = exact_dedup.ExactIndex(spark, path)
    index.insert(spark.createDataFrame([(1, "a")], SCHEMA))
    spark.createDataFrame([(0, 0, 9, 1, 1)], "prefix long, depth int, generation int, entries long, bytes long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{path}/directory/generation=9")
    again = exact_dedup.ExactIndex(spark, path)
    assert again.generation == 1
    again.insert(spark.createDataFrame([(2, "a"), (3, "b")], SCHEMA))
    assert {(r["keep"], r["n"]) for r in again.entries().collect()} == {(1, 2), (3, 1)}
