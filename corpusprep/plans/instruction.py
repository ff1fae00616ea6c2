"""Instruction data: pages to title records, code to docstring records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io
from corpusprep.plans.inputs import ARTICLES_SQL, CODE_SQL, articles, code_elements, documents, split_sql
from corpusprep.session import scratch_path

SPLITS = {"train": 0.9, "eval": 0.1}


def _prompt_sql(text: str, lines: fn.PromptText) -> str:
    return f"'{lines.instruction}\n{lines.input_key}\n' || {text} || '\n{lines.response_key}\n'"


def _message_sql(prompt: str, response: str) -> str:
    turns = (("system", f"'{fn.DEFAULT_SYSTEM}'"), ("user", prompt), ("assistant", response))
    array = ", ".join(f"{{'role': '{role}', 'content': {content}}}" for role, content in turns)
    return f"to_json({{'messages': [{array}]}})::varchar"


# --- pages to title records -------------------------------------------------


def distinct_articles(spark: SparkSession, folder: str) -> DataFrame:
    # Deduplication reads its rows twice: the page patterns run once, before it.
    path = scratch_path(spark, "articles")
    articles(spark, folder).select("page_id", "title", "text").write.parquet(path)
    filled = op.load_and_filter(spark.read.parquet(path))
    return op.dedup_exact(filled, ["text", "title"], keep_by="page_id")


def title_pairs(spark: SparkSession, folder: str) -> DataFrame:
    prompted = distinct_articles(spark, folder).withColumn("prompt", fn.instruction_prompt("text", fn.TITLE_PROMPT))
    return prompted.selectExpr("page_id", "prompt", "title as response")


def title_messages(spark: SparkSession, folder: str) -> DataFrame:
    pairs = title_pairs(spark, folder)
    return pairs.withColumn("message", fn.chat_message("prompt", "response")).drop("prompt", "response")


def pair_lines(spark: SparkSession, folder: str) -> DataFrame:
    pairs = title_pairs(spark, folder)
    return pairs.select("page_id", fn.pair_json("prompt", "response").alias("line"))


def chat_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    split = op.split_by_hash(title_messages(spark, folder), SPLITS, "page_id")
    path = scratch_path(spark, "chat-jsonl")
    io.write_jsonl(split, path, split_col="split")
    back = io.read_chat_jsonl(spark, path)
    return back.select(
        "split",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.col("messages")[1]["content"].alias("prompt"),
        F.col("messages")[2]["content"].alias("response"),
        F.col("corrupt").isNotNull().alias("is_corrupt"),
    )


_DISTINCT_SQL = f"""
with articles as ({ARTICLES_SQL}),
ranked as (
  select *, row_number() over (partition by text, title order by page_id) as rn
  from articles where text <> '' and title <> '')
select page_id, title, text from ranked where rn = 1"""
_TITLE_PAIRS_SQL = f"""
select page_id, {_prompt_sql('text', fn.TITLE_PROMPT)} as prompt, title as response
from ({_DISTINCT_SQL})"""


# --- code to docstring records ------------------------------------------------


def documented_functions(spark: SparkSession, folder: str) -> DataFrame:
    found = op.documented_functions(code_elements(spark, folder))
    return found.withColumn("fn_def", fn.function_signature("source"))


def docstring_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return documented_functions(spark, folder).select(
        "p_partkey",
        fn.instruction_prompt("fn_def", fn.DOCSTRING_PROMPT).alias("prompt"),
        F.col("doc_string").alias("response"),
    )


def docstring_messages(spark: SparkSession, folder: str) -> DataFrame:
    pairs = docstring_pairs(spark, folder)
    return pairs.select("p_partkey", fn.chat_message("prompt", "response").alias("message"))


def function_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return code_elements(spark, folder).select(
        "p_partkey",
        fn.function_signature("source").alias("signature"),
        fn.function_signature("source", missing="compat").alias("signature_compat"),
    )


_DOCUMENTED_SQL = f"""
select *, split_part(source, '\"\"\"', 1) as fn_def from ({CODE_SQL})
where doc_string is not null and element_type = 'function' and args is not null
  and length(args) > 0 and contains(doc_string, 'Parameters')"""
_DOCSTRING_PAIRS_SQL = f"""
select p_partkey, {_prompt_sql('fn_def', fn.DOCSTRING_PROMPT)} as prompt, doc_string as response
from ({_DOCUMENTED_SQL})"""


# --- filters, dedup, splits, messages -------------------------------------------


def non_empty_rows(spark: SparkSession, folder: str) -> DataFrame:
    return op.filter_null_or_empty(code_elements(spark, folder), ["doc_string", "args"])


def filter_report(spark: SparkSession, folder: str) -> DataFrame:
    return op.filter_report(code_elements(spark, folder), ["doc_string", "args"])


def dedup_articles(spark: SparkSession, folder: str) -> DataFrame:
    return op.dedup_exact(documents(spark, folder), ["text"], keep_by="doc_id")


def train_eval_split(spark: SparkSession, folder: str) -> DataFrame:
    return op.split_by_hash(documents(spark, folder), SPLITS, "doc_id").select("doc_id", "split")


def train_eval_random(spark: SparkSession, folder: str) -> DataFrame:
    # The draw depends on the partitioning; that each row is on one side does not.
    sides = op.split_random(documents(spark, folder).select("doc_id"), list(SPLITS.values()))
    train, evaluation = (side.select("doc_id", F.lit(name).alias("split")) for side, name in zip(sides, SPLITS))
    filled = F.lit(not train.isEmpty() and not evaluation.isEmpty())
    return train.union(evaluation).groupBy("doc_id").agg(F.count("split").alias("n_sides")).withColumn("both_filled", filled)


def exchange_messages(spark: SparkSession, folder: str) -> DataFrame:
    records = op.exchange_messages(io.read_table(spark, "conversations", folder))
    return records.select("conv_id", "turn", fn.chat_json("messages").alias("message"))


def chat_validity(spark: SparkSession, folder: str) -> DataFrame:
    # Every turn as a record of its own, most of them no record to train on, and
    # every exchange.
    turns = io.read_table(spark, "conversations", folder)
    alone = turns.select("conv_id", "turn", F.array(F.struct("role", F.col("text").alias("content"))).alias("messages"))
    records = alone.withColumn("kind", F.lit("turn")).unionByName(op.exchange_messages(turns).withColumn("kind", F.lit("exchange")))
    return records.select("conv_id", "turn", "kind", fn.chat_fault("messages").alias("fault"))


def turn_with_system(spark: SparkSession, folder: str) -> DataFrame:
    turns = io.read_table(spark, "conversations", folder)
    alone = F.array(F.struct("role", F.col("text").alias("content")))
    return turns.select("conv_id", "turn", fn.chat_json(fn.with_system(alone)).alias("message"))


QUERIES = {
    "title_messages": title_messages,
    "title_pairs": title_pairs,
    "pair_lines": pair_lines,
    "chat_jsonl_roundtrip": chat_jsonl_roundtrip,
    "page_articles": articles,
    "documented_functions": documented_functions,
    "docstring_pairs": docstring_pairs,
    "docstring_messages": docstring_messages,
    "function_signatures": function_signatures,
    "non_empty_rows": non_empty_rows,
    "filter_report": filter_report,
    "dedup_articles": dedup_articles,
    "train_eval_split": train_eval_split,
    "train_eval_random": train_eval_random,
    "turn_with_system": turn_with_system,
    "exchange_messages": exchange_messages,
    "chat_validity": chat_validity,
}

_EXCHANGES_SQL = f"""
select u.conv_id, u.turn, coalesce(s.text, '{fn.DEFAULT_SYSTEM}') as system, u.text as prompt, a.text as answer
from conversations u
join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
left join (select conv_id, arg_min(text, turn) as text from conversations where role = 'system' group by conv_id) s
  on s.conv_id = u.conv_id
where u.role = 'user'"""
_BLANK_SQL = "coalesce(trim({}), '') = ''"

ORACLES = {
    "exchange_messages": f"""
        select conv_id, turn, to_json({{'messages': [{{'role': 'system', 'content': system}},
          {{'role': 'user', 'content': prompt}}, {{'role': 'assistant', 'content': answer}}]}})::varchar as message
        from ({_EXCHANGES_SQL})""",
    "chat_validity": f"""
        select conv_id, turn, 'turn' as kind, case when role not in ('system', 'user', 'assistant') then 'unknown role'
          when role <> 'user' then 'no user turn' else 'last turn is not the assistant''s' end as fault
        from conversations
        union all
        select conv_id, turn, 'exchange', case when {_BLANK_SQL.format('system')} or {_BLANK_SQL.format('prompt')}
          or {_BLANK_SQL.format('answer')} then 'empty content' end
        from ({_EXCHANGES_SQL})""",
    "train_eval_random": "select doc_id, count(*) as n_sides, true as both_filled from documents group by doc_id",
    "title_messages": f"select page_id, {_message_sql('prompt', 'response')} as message from ({_TITLE_PAIRS_SQL})",
    "title_pairs": _TITLE_PAIRS_SQL,
    "pair_lines": f"""
        select page_id, to_json({{'prompt': prompt, 'response': response}})::varchar as line
        from ({_TITLE_PAIRS_SQL})""",
    "chat_jsonl_roundtrip": f"""
        select {split_sql(42, "page_id", SPLITS)} as split,
          cast(3 as bigint) as n_messages, prompt, response, false as is_corrupt
        from ({_TITLE_PAIRS_SQL})""",
    "page_articles": ARTICLES_SQL,
    "documented_functions": _DOCUMENTED_SQL,
    "docstring_pairs": _DOCSTRING_PAIRS_SQL,
    "docstring_messages": f"""
        select p_partkey, {_message_sql('prompt', 'response')} as message from ({_DOCSTRING_PAIRS_SQL})""",
    "function_signatures": f"""
        select p_partkey, split_part(source, '\"\"\"', 1) as signature,
          case when contains(source, '\"\"\"') then split_part(source, '\"\"\"', 1)
               else left(source, greatest(length(source) - 1, 0)) end as signature_compat
        from ({CODE_SQL})""",
    "non_empty_rows": f"""
        select * from ({CODE_SQL})
        where doc_string is not null and doc_string <> '' and args is not null and args <> ''""",
    "filter_report": f"""
        select count(*) as in_rows,
          count(*) - count(*) filter (where doc_string <> '' and args <> '') as dropped_rows,
          count(*) filter (where doc_string <> '' and args <> '') as kept_rows
        from ({CODE_SQL})""",
    "dedup_articles": """
        select * from documents d
        where not exists (select 1 from documents e where e.text = d.text and e.doc_id < d.doc_id)""",
    "train_eval_split": f"""
        select doc_id, {split_sql(42, "doc_id", SPLITS)} as split from documents""",
    "turn_with_system": f"""
        select conv_id, turn, case when role = 'system'
          then to_json({{'messages': [{{'role': role, 'content': text}}]}})::varchar
          else to_json({{'messages': [{{'role': 'system', 'content': '{fn.DEFAULT_SYSTEM}'}},
                                      {{'role': role, 'content': text}}]}})::varchar end as message
        from conversations""",
}
