"""What the plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io
from corpusprep.functions import html
from corpusprep.operators import ordering
from corpusprep.plans import QUERIES, inputs


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    """The final plan after a run; the DataFrame keeps it when it is collected."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


#: Through this package's own Python data sources, or the user's function.
SOURCES = {"text_folder_roundtrip", "sharded_samples", "window_shuffled_samples", "shuffle_spread"}
NATIVE = sorted(set(QUERIES) - {"map_text"} - SOURCES)


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_bucket_sums_meet_in_one_partition(spark, sf, monkeypatch):
    monkeypatch.setattr(ordering, "MIN_ROWS_PER_BUCKET", 5)  # some tables here are one bucket
    for name in ("packed_samples", "batches", "eval_subset", "run_timeline", "rolling_metric"):
        lines = plan(QUERIES[name](spark, sf)).splitlines()
        for at, line in enumerate(lines):
            if "SinglePartition" in line:
                assert "HashAggregate" in lines[at + 1], f"{name}: {lines[at + 1]}"


def shuffled_columns(df) -> list[set[str]]:
    """The columns that each exchange of the plan carries."""
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            output = node.output()
            found.append({output.apply(i).name() for i in range(output.size())})
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(df._jdf.queryExecution().executedPlan().initialPlan())
    return found


def test_packing_never_shuffles_tokens(spark, sf):
    df = op.pack_tokens(inputs.documents(spark, sf), fn.whitespace_tokens("text"), "doc_id")
    moved = shuffled_columns(df)
    assert sum("text" in c for c in moved) == 2  # to the starts, and to the ranges
    assert not any(c & {"tokens", "_all", "_pieces", "_tokens", "buf"} for c in moved)
    small = [c for c in moved if "text" not in c]
    assert all(c <= {"doc_id", "_k0", "_n", "_start", "_bucket", "_sum"} for c in small)
    assert plan(df).count("ShuffledHashJoin") == 1


def test_whole_documents_are_sent_as_text(spark, sf):
    """Only documents that reach into a second range carry tokens."""
    df = op.pack_tokens(inputs.documents(spark, sf).select("doc_id", "text"), fn.whitespace_tokens("text"), "doc_id")
    text = plan(df)
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {"doc_id:bigint,text:string"}


def test_packing_counts_tokens_once_for_starts_and_sums(spark, sf):
    df = op.pack_tokens(inputs.documents(spark, sf), fn.whitespace_tokens("text"), "doc_id")
    assert "ReusedExchange" in run_plan(df)


def test_budget_is_a_filter_in_the_scan(spark, sf):
    text = plan(QUERIES["token_budget"](spark, sf))
    assert "LessThanOrEqual(doc_id" in text and "Exchange" not in text


def test_corpus_filters_reach_the_scan(spark, sf):
    text = plan(QUERIES["corpus_subset"](spark, sf))
    assert "EqualTo(source,src0)" in text and "EqualTo(lang,en)" in text and "Exchange" not in text


def test_splits_read_keys_only_and_do_not_shuffle(spark, sf):
    text = plan(QUERIES["train_eval_split"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint>" in text and "Exchange" not in text


def test_article_expressions_run_once(spark, sf):
    assert plan(QUERIES["page_articles"](spark, sf)).count(html._ARTICLE) == 1
    # Behind a deduplication, which reads its rows twice, they have run before.
    assert html._ARTICLE not in plan(QUERIES["title_messages"](spark, sf))


@pytest.mark.parametrize("name", ["dedup_articles", "title_messages", "latest_event", "response_comparison"])
def test_no_payload_is_sorted_by_an_aggregate(spark, sf, name):
    for line in plan(QUERIES[name](spark, sf)).splitlines():
        if "SortAggregate" in line:
            assert not re.search(r"\b(text|title|content|_answer|props|value)#", line), line


@pytest.mark.parametrize("name", ["dedup_articles", "latest_event"])
def test_groups_shrink_before_the_shuffle(spark, sf, name):
    lines = plan(QUERIES[name](spark, sf)).splitlines()
    aggregates = [line for line in lines if "Aggregate" in line]
    assert aggregates and sum("partial_" in line for line in aggregates) >= 2


def test_bounds_are_constants(spark):
    df = spark.range(5000).withColumn("text", F.lit("a"))
    text = plan(op.with_position(df, "id"))
    assert "from_json" not in text and "Sample" not in text


def test_window_shuffle_moves_no_samples(spark, tmp_path):
    path = str(tmp_path / "shards")
    io.write_shards(spark.range(100).selectExpr("id as sample", "array(cast(id as int)) as tokens"), path, shard_samples=10)
    shuffled = io.shuffled_shards(spark, path, window=3)
    assert "Exchange" not in plan(shuffled) and "Sort" not in plan(shuffled)
    assert shuffled.rdd.getNumPartitions() == 4
