"""Edge rows of the text, prompt, chat and filter operators."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op


def one_column(spark, values, name="c"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, {name} STRING")


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


SOURCES = ['def f():\n    """Doc."""', "def f(): pass", "", '"""only"""', None]


def test_signature_keeps_source_without_docstring(spark):
    df = one_column(spark, SOURCES)
    assert values(df, fn.function_signature("c")) == ["def f():\n    ", "def f(): pass", "", "", None]


def test_signature_compat_equals_python_slice(spark):
    df = one_column(spark, SOURCES)
    sliced = [None if s is None else s[: s.find('"""')] for s in SOURCES]
    assert values(df, fn.function_signature("c", missing="compat")) == sliced
    with pytest.raises(ValueError):
        fn.function_signature("c", missing="other")


def test_prompt_lines_and_null(spark):
    df = one_column(spark, ["body", None])
    lines = fn.PromptText("Do it.", "### In", "### Out")
    assert values(df, fn.instruction_prompt("c", lines)) == ["Do it.\n### In\nbody\n### Out\n", None]


def test_file_names(spark):
    df = one_column(spark, ["a/x.md", "b/x.md", "x_md", "plain", "dir/", "v1.2/a.b.c", None])
    assert values(df, fn.file_stem("c")) == ["x_md", "x_md", "x_md", "plain", "", "a_b_c", None]
    assert values(df, fn.file_path("/out/", fn.file_stem("c")))[0] == "/out/x_md.txt"
    unique = values(df, fn.unique_stem("c"))
    assert len(set(unique)) == 7 and unique[0].startswith("x_md-")


PAIRS = [("Ünïcode \"quoted\"\n  🙂", "ok"), ("p", None), (None, "r"), ("", "")]


@pytest.mark.parametrize("ascii_only", [False, True])
def test_chat_message_parses_to_the_same_record(spark, ascii_only):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PAIRS)], "i INT, p STRING, r STRING")
    lines = values(df, fn.chat_message("p", "r", ascii=ascii_only))
    for line, (prompt, response) in zip(lines, PAIRS):
        assert "\n" not in line
        assert line.isascii() or not ascii_only
        assert json.loads(line) == {
            "messages": [
                {"role": "system", "content": fn.DEFAULT_SYSTEM},
                {"role": "user", "content": prompt},
                {"role": "assistant", "content": response},
            ]
        }


def test_docstring_record(spark):
    source = 'def merge_rows(\n    left: Dict[str, int],\n    keys: List[str],\n) -> None:\n    """\n    Merge them.\n    """'
    df = one_column(spark, [source])
    prompt = fn.instruction_prompt(fn.function_signature("c"), fn.DOCSTRING_PROMPT)
    record = json.loads(values(df, fn.chat_message(prompt, F.lit("Merge them.")))[0])
    assert [m["role"] for m in record["messages"]] == ["system", "user", "assistant"]
    assert record["messages"][1]["content"] == (
        "The following is a pyspark function definition. Write a numpy style docstring for the provided function "
        "definition.\n### Function definition\n" + source.split('"""')[0] + "\n### Numpy style docstring\n"
    )


def test_pair_json_keeps_null(spark):
    df = spark.createDataFrame([(0, "p", None)], "i INT, p STRING, r STRING")
    assert json.loads(values(df, fn.pair_json("p", "r"))[0]) == {"prompt": "p", "response": None}


def test_with_system_only_if_absent(spark):
    schema = "i INT, m ARRAY<STRUCT<role: STRING, content: STRING>>"
    rows = [(0, [("user", "a")]), (1, [("system", "s"), ("user", "b")]), (2, []), (3, [(None, "c")])]
    df = spark.createDataFrame(rows, schema)
    got = [[m["role"] for m in v] for v in values(df, fn.with_system("m"))]
    assert got == [["system", "user"], ["system", "user"], ["system"], ["system", None]]


PAGES = {
    "<html><title> A &amp; B </title><article><p>x</p>\n<p>y &lt;z&gt; &quot;q&quot; &#39;s&#39;&nbsp;e</p></article>": (
        "A & B",
        "x\n\ny <z> \"q\" 's' e",
    ),
    "<TITLE>T</TITLE><script>var a='</p><article>no</article>'</script><ARTICLE class='a'>yes</ARTICLE>": ("T", "yes"),
    "<title>&amp;lt;</title><article><!-- <b>gone</b> -->kept<style>p{}</style></article><article>2nd</article>": (
        "&lt;",
        "kept",
    ),
    "no markup": ("", ""),
    "<title>t</title><article>never closed <article>twice": ("t", ""),
    "</article><title>t</title><article>a < b <i>c</i></article><article>d</article>": ("t", "a < b c"),
    "<title>t</title><article>a</article><script>to the end <article>": ("t", "a"),
    "<!-- <title>no</title> <article>x</article>": ("", ""),
    "<title>a &amp;amp; &#39;b&#x27; &mdash;&eacute;&#8217;&apos;&hellip;</title><article>&bogus; &#xD800; &#0; &; & &#128512;&lt</article>": (
        "a &amp; 'b' \u2014\u00e9\u2019'\u2026",
        "&bogus; &#xD800; &#0; &; & \U0001f600&lt",
    ),
    "": ("", ""),
}


def test_articles(spark):
    df = one_column(spark, list(PAGES), "html")
    got = [tuple(r) for r in op.extract_article(df).orderBy("i").select("title", "text").collect()]
    assert got == list(PAGES.values())
    assert values(df, fn.page_title("html")) == [t for t, _ in PAGES.values()]
    assert values(df, fn.article_text("html")) == [t for _, t in PAGES.values()]
    flat = [" ".join(t.split("\n\n")) for _, t in PAGES.values()]
    assert values(df, fn.article_text("html", paragraphs=False)) == flat
    assert values(op.extract_article(df, paragraphs=False), "text") == flat


@pytest.mark.parametrize("broken", ["<", "<article", "<article>", "<title>", "<script>", "<!--", "<style <b"])
def test_broken_pages_take_one_pass(spark, broken):
    # A pattern that starts over at every tag would need hours for these.
    page = f"<article>{broken * 100_000}</article>"
    assert op.extract_article(one_column(spark, [page, broken * 300_000], "html")).count() == 2
    assert len(op.extract_article(one_column(spark, [page, broken * 300_000], "html")).collect()) == 2


def test_tokens(spark):
    df = one_column(spark, ["a b", "  a\t\nb ", "", " ", "one", None])
    assert values(df, fn.whitespace_tokens("c")) == [["a", "b"], ["a", "b"], [], [], ["one"], None]
    assert values(df, fn.with_eos(fn.whitespace_tokens("c")))[0] == ["a", "b", fn.DEFAULT_EOS]


TEXTS = [("1", None, "t"), ("2", "", "t"), ("3", " ", "t"), ("4", "x", None), ("5", "x", ""), ("6", "x", "t"), ("7", "x", "t")]


def test_filter_keeps_blank_text_unless_trimmed(spark):
    df = spark.createDataFrame(TEXTS, "id STRING, text STRING, title STRING")
    assert [r["id"] for r in op.filter_null_or_empty(df, ["text", "title"]).orderBy("id").collect()] == ["3", "6", "7"]
    trimmed = op.filter_null_or_empty(df, ["text", "title"], trim=True)
    assert [r["id"] for r in trimmed.orderBy("id").collect()] == ["6", "7"]


def test_load_and_filter_counts_in_the_same_pass(spark):
    df = spark.createDataFrame(TEXTS, "id STRING, text STRING, title STRING")
    counts = Observation("counts")
    assert op.load_and_filter(df, observation=counts).count() == 3
    assert counts.get == {"in_rows": 7, "dropped_rows": 4, "kept_rows": 3}
    df.createOrReplaceTempView("texts_and_titles")
    assert op.load_and_filter("texts_and_titles").count() == 3
    report = op.filter_report(df, ["text", "title"]).first().asDict()
    assert report == counts.get


def test_dedup_keeps_the_smallest_key_and_null_is_not_empty(spark):
    rows = [("9", "x", "t"), ("2", "x", "t"), ("3", None, "t"), ("4", None, "t"), ("5", "", "t"), ("6", "xt", ""), ("7", "x", "T")]
    df = spark.createDataFrame(rows, "id STRING, text STRING, title STRING")
    kept = op.dedup_exact(df, ["text", "title"], keep_by="id")
    assert sorted(r["id"] for r in kept.collect()) == ["2", "3", "5", "6", "7"]
    assert sorted(op.dedup_exact(kept, ["text", "title"], keep_by="id").collect()) == sorted(kept.collect())


def test_latest_per_key_with_ties_and_hot_key(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 0, id) as run", "id div 2 as ts", "id as seq")
    latest = op.latest_per_key(df, "run", ["ts", "seq"])
    assert latest.columns == ["run", "ts", "seq"]
    assert latest.filter("run = 0").first()["seq"] == 8997
    assert latest.count() == 6001


def test_map_text_keeps_null(spark):
    df = one_column(spark, ["ab", None, ""])
    assert values(op.map_text(df, "c", lambda texts: texts.str[::-1], "out"), "out") == ["ba", None, ""]


def test_map_text_gives_a_few_texts_at_a_time(spark):
    def counted(texts):
        assert len(texts) <= 512
        return texts + f":{texts.notna().all()}"

    df = spark.range(3000).coalesce(1).selectExpr("id", "if(id % 7 = 0, null, concat('é', id)) as c")
    got = {r["id"]: r["out"] for r in op.map_text(df, "c", counted, "out").collect()}
    assert got == {i: None if i % 7 == 0 else f"é{i}:True" for i in range(3000)}


def test_flatten_nested(spark):
    schema = "name STRING, provider STRING, instances ARRAY<STRUCT<name: STRING, gpus: INT>>"
    rows = [("c1", "p", [("a", 1), ("b", 2)]), ("c2", "q", []), ("c3", "q", None)]
    df = spark.createDataFrame(rows, schema)
    flat = op.flatten_nested(
        df, "instances", {"name": "Cluster Name", "provider": "Provider"}, {"name": "Instance Name", "gpus": "GPUs"}
    )
    assert flat.columns == ["Cluster Name", "Provider", "Instance Name", "GPUs"]
    assert sorted(tuple(r) for r in flat.collect()) == [("c1", "p", "a", 1), ("c1", "p", "b", 2)]
    assert op.flatten_nested(df.drop("name"), "instances", ["provider"]).columns == ["provider", "name", "gpus"]


def test_compare_responses(spark):
    a = spark.createDataFrame([(1, "x", "ref"), (2, "y", "ref")], "key INT, content STRING, reference STRING")
    b = spark.createDataFrame([(1, "z"), (3, "w")], "key INT, content STRING")
    got = op.compare_responses(a, b, "key").select("key", "answer_a", "answer_b", "reference").collect()
    assert [tuple(r) for r in got] == [(1, "x", "z", "ref")]
    with pytest.raises(Exception, match="second answer"):
        op.compare_responses(a, b.union(b), "key").collect()


TURNS = [
    ("a", 0, "system", "be brief"), ("a", 1, "user", "q1"), ("a", 2, "assistant", "r1"), ("a", 3, "user", "q2"), ("a", 4, "user", "q3"),
    ("a", 5, "assistant", "r3"), ("b", 0, "user", "q"), ("b", 1, "assistant", " "), ("c", 0, "assistant", "x"), ("d", 0, "user", None),
]


def test_exchanges_and_their_faults(spark):
    df = spark.createDataFrame(TURNS, "conv_id STRING, turn INT, role STRING, text STRING").repartition(3)
    rows = op.exchange_messages(df).select("conv_id", "turn", "messages.content", fn.chat_fault("messages").alias("fault")).collect()
    got = {(r["conv_id"], r["turn"]): (r["content"], r["fault"]) for r in rows}
    assert got == {
        ("a", 1): (["be brief", "q1", "r1"], None),
        ("a", 4): (["be brief", "q3", "r3"], None),
        ("b", 0): ([fn.DEFAULT_SYSTEM, "q", " "], "empty content"),
    }


def test_chat_faults(spark):
    schema = "i INT, m ARRAY<STRUCT<role: STRING, content: STRING>>"
    rows = [[("user", "a"), ("assistant", "b")], [("robot", "a")], [(None, "a")], [("system", "s"), ("assistant", "b")], [("user", "a")], [("user", None), ("assistant", "b")], [], None]
    df = spark.createDataFrame(list(enumerate(rows)), schema)
    assert values(df, fn.chat_fault("m")) == [
        None, "unknown role", "unknown role", "no user turn", "last turn is not the assistant's", "empty content", "no turn", "no turn",
    ]


def test_one_row_per_key_needs_an_order(spark):
    df = spark.createDataFrame([("x", 1, "p"), ("x", 1, "q"), ("y", 1, "p"), ("y", 2, "p")], "k STRING, o INT, v STRING")
    with pytest.raises(Exception, match="do not tell the rows of a key apart"):
        op.latest_per_key(df, "k", ["o"]).collect()
    assert [r["o"] for r in op.latest_per_key(df.filter("k = 'y'"), "k", ["o"]).collect()] == [2]


def test_null_keys_and_names_with_blanks(spark):
    df = spark.createDataFrame([(None, 1, "p"), (None, 2, "q"), ("z", None, "r")], "`run name` STRING, `order.id` INT, v STRING")
    assert sorted(r["v"] for r in op.latest_per_key(df, "run name", ["order.id"]).collect()) == ["q", "r"]
    assert sorted(r["v"] for r in op.dedup_exact(df, ["run name"], "order.id").collect()) == ["p", "r"]


def test_token_counts_equal_the_arrays(spark):
    df = one_column(spark, ["a b", "  a\t\nb ", "", " ", "one", None, "\u00a0 x\x0by"])
    counted = [r[0] for r in df.orderBy("i").select(fn.count_tokens("c")).collect()]
    assert counted == [r[0] for r in df.orderBy("i").select(F.size(fn.whitespace_tokens("c"))).collect()]
