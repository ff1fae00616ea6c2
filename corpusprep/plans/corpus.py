"""Corpus export and packing: documents to text files and token samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep import functions as fn
from corpusprep import operators as op
from corpusprep import sources as io
from corpusprep.plans.inputs import TOKENS_SQL, documents, split_sql
from corpusprep.session import scratch_path

CORPUS_SPLITS = {"train_small": 0.9, "val_small": 0.1}
SHORT = 128
#: Samples of a shard, and shards of a shuffle's window.
SHARD, WINDOW = 64, 4


def _tokens() -> Column:
    return fn.whitespace_tokens("text")


def _split_documents(spark: SparkSession, folder: str) -> DataFrame:
    return op.split_by_hash(documents(spark, folder), CORPUS_SPLITS, "doc_id", seed=17)


def _counted(spark: SparkSession, folder: str) -> DataFrame:
    # The end-of-text token counts too.
    return documents(spark, folder).withColumn("n_tokens", fn.count_tokens("text") + 1)


def _split_samples(spark: SparkSession, folder: str, length: int = SHORT) -> DataFrame:
    return op.pack_tokens(_split_documents(spark, folder), _tokens(), "doc_id", length=length, group_by="split")


# --- export ---------------------------------------------------------------------


def export_names(spark: SparkSession, folder: str) -> DataFrame:
    pages = io.read_table(spark, "pages", folder)
    return pages.select(
        "page_id", fn.file_stem("url").alias("name"), fn.file_path("/corpus", fn.file_stem("url")).alias("path")
    )


def export_name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return io.export_name_collisions(io.read_table(spark, "pages", folder), "url")


def text_folder_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "text-folder")
    doc_path = F.concat("source", F.lit("/"), "lang", F.lit("/doc."), "doc_id")
    corpus = op.filter_null_or_empty(documents(spark, folder), ["text"]).withColumn("uuid", doc_path)
    io.write_text_folder(corpus, "uuid", "text", path)
    return io.read_text_folder(spark, path)


# --- tokens -----------------------------------------------------------------------


def corpus_subset(spark: SparkSession, folder: str) -> DataFrame:
    chosen = op.select_corpus(documents(spark, folder), "src0", "en", CORPUS_SPLITS, seed=17)
    return chosen.select("doc_id", "text", "split")


def corpus_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _split_documents(spark, folder).select("doc_id", "split")


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", fn.count_tokens("text").alias("n_tokens"))


def token_counts_eos(spark: SparkSession, folder: str) -> DataFrame:
    full = fn.with_eos(_tokens())
    return documents(spark, folder).select(
        "doc_id", F.size(full).cast("bigint").alias("n_tokens"), F.element_at(full, -1).alias("last_token")
    )


def packed_samples(spark: SparkSession, folder: str) -> DataFrame:
    packed = op.pack_tokens(documents(spark, folder), _tokens(), "doc_id")
    return packed.select("sample", F.array_join("tokens", " ").alias("tokens"))


def packed_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "packed")
    io.write_packed(_split_samples(spark, folder), path)
    return io.read_packed(spark, path).select("split", "sample", F.array_join("tokens", " ").alias("tokens"))


def shuffled_samples(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "packed")
    io.write_packed(_split_samples(spark, folder), path)
    shuffled = op.shuffle_into_order(io.read_packed(spark, path, "train_small"), "sample")
    return shuffled.select("position", "sample", F.array_join("tokens", " ").alias("tokens"))


def sharded_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of the training length would do as well; strings show more."""
    path = scratch_path(spark, "shards")
    io.write_shards(_split_samples(spark, folder), path, split_col="split", shard_samples=SHARD)
    return io.read_shards(spark, path).select("split", "sample", F.array_join("tokens", " ").alias("tokens"))


def _window_shuffled(spark: SparkSession, folder: str, tokens: bool = True) -> DataFrame:
    path = scratch_path(spark, "shards")
    io.write_shards(_split_samples(spark, folder), path, split_col="split", shard_samples=SHARD)
    return io.shuffled_shards(spark, path, "train_small", window=WINDOW, tokens=tokens)


def window_shuffled_samples(spark: SparkSession, folder: str) -> DataFrame:
    return _window_shuffled(spark, folder).select("position", "sample", F.array_join("tokens", " ").alias("tokens"))


def shuffle_spread(spark: SparkSession, folder: str) -> DataFrame:
    return io.shuffle_spread(_window_shuffled(spark, folder, tokens=False))


def packed_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The samples of the training runs' own length, for each split."""
    samples = _split_samples(spark, folder, op.SAMPLE_LENGTH)
    return samples.select("split", "sample", F.array_join("tokens", " ").alias("tokens"))


def batches(spark: SparkSession, folder: str) -> DataFrame:
    shuffled = op.shuffle_rows(documents(spark, folder).select("doc_id"), "doc_id", total="n_rows")
    return op.assign_batches(shuffled, batch_size=64, drop_last=True, total="n_rows").drop("n_rows")


def sample_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The whole chain: a subset, its splits, packed samples, the train samples in
    shuffled order, full batches, written and read back."""
    chosen = documents(spark, folder).filter("lang = 'en'")
    split = op.split_by_hash(chosen, CORPUS_SPLITS, "doc_id", seed=17)
    packed = scratch_path(spark, "packed")
    io.write_packed(op.pack_tokens(split, _tokens(), "doc_id", length=SHORT, group_by="split"), packed)
    train = op.shuffle_into_order(io.read_packed(spark, packed, "train_small"), "sample", total="n_rows")
    out = scratch_path(spark, "batches")
    op.assign_batches(train, batch_size=16, drop_last=True, total="n_rows").drop("n_rows").write.parquet(out)
    back = spark.read.parquet(out)
    return back.select("batch", "position", "sample", F.array_join("tokens", " ").alias("tokens"))


def eval_subset(spark: SparkSession, folder: str) -> DataFrame:
    held_out = _split_documents(spark, folder).filter("split = 'val_small'")
    placed = op.with_position(held_out.select("doc_id", "text"), "doc_id")
    return op.eval_subset(op.assign_batches(placed, batch_size=16), batches=2)


def token_budget(spark: SparkSession, folder: str) -> DataFrame:
    return op.take_duration(_counted(spark, folder), "100000tok", "n_tokens", "doc_id").select("doc_id", "n_tokens", "epoch")


def token_budget_epochs(spark: SparkSession, folder: str) -> DataFrame:
    """A budget of more than one pass, with keys of two columns."""
    counted = _counted(spark, folder).select("lang", "doc_id", "n_tokens")
    return op.take_duration(counted, "1000000tok", "n_tokens", ["lang", "doc_id"])


def duration_batches(spark: SparkSession, folder: str) -> DataFrame:
    counted = _counted(spark, folder).select("doc_id", "n_tokens")
    return op.take_duration(counted, "20ba", "n_tokens", "doc_id", batch_size=64, length=SHORT)


def epoch_expand(spark: SparkSession, folder: str) -> DataFrame:
    corpus = documents(spark, folder).select("doc_id", "text")
    return op.take_duration(corpus, "3ep", "text", "doc_id")


def token_report(spark: SparkSession, folder: str) -> DataFrame:
    return op.token_report(_counted(spark, folder), "n_tokens", "lang", length=SHORT, batch_size=64)


def token_cube(spark: SparkSession, folder: str) -> DataFrame:
    """By language and split, each of them, and in all."""
    counted = _split_documents(spark, folder).withColumn("n_tokens", fn.count_tokens("text") + 1)
    return op.token_cube(counted, "n_tokens", ["lang", "split"], length=SHORT, batch_size=64)


def token_budget_by_files(spark: SparkSession, folder: str) -> DataFrame:
    """The budget of ``token_budget``, over files in the order of their keys."""
    path, counts = scratch_path(spark, "corpus"), scratch_path(spark, "token-counts")
    documents(spark, folder).repartitionByRange(16, "doc_id").write.parquet(path)
    n_tokens = fn.count_tokens("text") + 1
    io.write_token_counts(spark, path, counts, n_tokens, "doc_id")
    taken = io.take_counted_budget(spark, path, counts, n_tokens, "doc_id", 100_000)
    return taken.select("doc_id", n_tokens.alias("n_tokens"), "epoch")


# --- records ------------------------------------------------------------------------


def flatten_nested(spark: SparkSession, folder: str) -> DataFrame:
    def line(text, i):
        return F.struct((i + 1).alias("no"), text.alias("text"), F.length(text).alias("chars"))

    nested = documents(spark, folder).withColumn("lines", F.transform(F.split("text", "\n"), line))
    return op.flatten_nested(
        nested,
        "lines",
        {"doc_id": "doc_id", "lang": "language"},
        {"no": "line_number", "text": "line_text", "chars": "line_chars"},
    )


def response_comparison(spark: SparkSession, folder: str) -> DataFrame:
    # Two answers for each document: its text as it is, and with single blanks.
    corpus = documents(spark, folder)
    a = corpus.select("doc_id", "lang", F.col("text").alias("content"))
    b = corpus.select("doc_id", F.array_join(_tokens(), " ").alias("content"))
    return op.compare_responses(a, b, "doc_id")


def map_text(spark: SparkSession, folder: str) -> DataFrame:
    corpus = documents(spark, folder).select("doc_id", "text")
    return op.map_text(corpus, "text", lambda texts: texts.str.replace("e", "3", regex=False), "mapped")


QUERIES = {
    "export_names": export_names,
    "export_name_collisions": export_name_collisions,
    "text_folder_roundtrip": text_folder_roundtrip,
    "corpus_subset": corpus_subset,
    "corpus_splits": corpus_splits,
    "token_counts": token_counts,
    "token_counts_eos": token_counts_eos,
    "packed_samples": packed_samples,
    "packed_roundtrip": packed_roundtrip,
    "shuffled_samples": shuffled_samples,
    "sharded_samples": sharded_samples,
    "window_shuffled_samples": window_shuffled_samples,
    "shuffle_spread": shuffle_spread,
    "packed_splits": packed_splits,
    "batches": batches,
    "sample_batches": sample_batches,
    "eval_subset": eval_subset,
    "token_budget": token_budget,
    "token_budget_epochs": token_budget_epochs,
    "duration_batches": duration_batches,
    "epoch_expand": epoch_expand,
    "token_report": token_report,
    "token_cube": token_cube,
    "token_budget_by_files": token_budget_by_files,
    "flatten_nested": flatten_nested,
    "response_comparison": response_comparison,
    "map_text": map_text,
}

_STEM_SQL = "replace(split_part(url, '/', -1), '.', '_')"
_SPLIT_SQL = split_sql(17, "doc_id", CORPUS_SPLITS)
_FULL_SQL = f"list_append({TOKENS_SQL}, '{fn.DEFAULT_EOS}')"
_COUNT_SQL = f"cast(len({_FULL_SQL}) as bigint)"


def _packed_sql(length: int, rows: str, where: str = "true") -> str:
    return f"""
        with split_docs as (select doc_id, text, {_SPLIT_SQL} as split from documents where {where}),
        docs as (select doc_id, {rows} as part, {_FULL_SQL} as toks from split_docs),
        opened as (select part, doc_id, unnest(toks) as tok, generate_subscripts(toks, 1) as i from docs),
        placed as (
          select part, tok, row_number() over (partition by part order by doc_id, i) - 1 as place from opened)
        select part, place // {length} as sample, string_agg(tok, ' ' order by place) as tokens
        from placed group by all having count(*) = {length}"""


_WINDOWS_SQL = f"""
        select row_number() over (order by w, md5('17:' || sample), sample) - 1 as position, sample, tokens
        from (
          select *, (dense_rank() over (order by md5('17:shard:' || sample // {SHARD}), sample // {SHARD}) - 1) // {WINDOW} as w
          from ({_packed_sql(SHORT, 'split')}) where part = 'train_small')"""


def _budget_sql(budget: str, order: str) -> str:
    """Passes over the corpus, one after the other, until the budget is reached."""
    return f"""
        with counted as (select lang, doc_id, {_COUNT_SQL} as n_tokens from documents),
        summed as (select *, sum(n_tokens) over (order by {order} rows unbounded preceding) - n_tokens as start,
          sum(n_tokens) over () as every from counted)
        select {order}, n_tokens, cast(e as integer) as epoch
        from summed, (select unnest(range(cast(({budget}) // (select sum(n_tokens) from counted) + 1 as bigint))) as e)
        where e * every + start < {budget}"""


ORACLES = {
    "export_names": f"select page_id, {_STEM_SQL} as name, '/corpus/' || {_STEM_SQL} || '.txt' as path from pages",
    "export_name_collisions": f"""
        select {_STEM_SQL} as name, count(*) as n_rows from pages group by 1 having count(*) > 1""",
    "text_folder_roundtrip": "select 'doc_' || doc_id as name, text from documents where text <> ''",
    "corpus_subset": f"""
        select doc_id, text, {_SPLIT_SQL} as split from documents where source = 'src0' and lang = 'en'""",
    "corpus_splits": f"select doc_id, {_SPLIT_SQL} as split from documents",
    "token_counts": f"select doc_id, cast(len({TOKENS_SQL}) as bigint) as n_tokens from documents",
    "token_counts_eos": f"""
        select doc_id, {_COUNT_SQL} as n_tokens, {_FULL_SQL}[-1] as last_token from documents""",
    "packed_samples": f"select sample, tokens from ({_packed_sql(2048, '0')})",
    "packed_roundtrip": f"select part as split, sample, tokens from ({_packed_sql(SHORT, 'split')})",
    "shuffled_samples": f"""
        select row_number() over (order by md5('17:' || sample), sample) - 1 as position, sample, tokens
        from ({_packed_sql(SHORT, 'split')}) where part = 'train_small'""",
    "sharded_samples": f"select part as split, sample, tokens from ({_packed_sql(SHORT, 'split')})",
    "window_shuffled_samples": _WINDOWS_SQL,
    "shuffle_spread": f"""
        with placed as ({_WINDOWS_SQL})
        select count(*) as n_samples, round(sum(abs(a.sample - a.position)) * 3 / (count(*)::double * count(*) - 1), 9) as moved,
          count(*) filter (where b.position + 1 = a.position) as kept_next
        from placed a left join placed b on b.sample + 1 = a.sample""",
    "packed_splits": f"select part as split, sample, tokens from ({_packed_sql(2048, 'split')})",
    "sample_batches": f"""
        with train as (select sample, tokens from ({_packed_sql(SHORT, 'split', "lang = 'en'")}) where part = 'train_small'),
        placed as (select *, row_number() over (order by md5('17:' || sample), sample) - 1 as position from train)
        select position // 16 as batch, position, sample, tokens from placed
        where position // 16 < (select count(*) // 16 from train)""",
    "batches": """
        with placed as (
          select doc_id, row_number() over (order by md5('17:' || doc_id), doc_id) - 1 as position from documents)
        select doc_id, position, position // 64 as batch from placed
        where position // 64 < (select count(*) // 64 from documents)""",
    "eval_subset": f"""
        with placed as (
          select doc_id, text, row_number() over (order by doc_id) - 1 as position
          from documents where {_SPLIT_SQL} = 'val_small')
        select doc_id, text, position, position // 16 as batch from placed where position // 16 < 2""",
    "token_budget": _budget_sql("100000", "doc_id"),
    "token_budget_epochs": _budget_sql("1000000", "lang, doc_id"),
    "duration_batches": _budget_sql(f"20 * 64 * {SHORT}", "doc_id"),
    "epoch_expand": "select doc_id, text, cast(epoch as integer) as epoch from documents, range(3) t(epoch)",
    "token_report": f"""
        with counted as (select lang, {_COUNT_SQL} as n_tokens from documents)
        select lang, count(*) as n_rows, cast(sum(n_tokens) as bigint) as n_tokens,
          cast(sum(n_tokens) // {SHORT} as bigint) as full_samples,
          cast(sum(n_tokens) // {SHORT} // 64 as bigint) as full_batches
        from counted group by lang""",
    "token_budget_by_files": _budget_sql("100000", "doc_id"),
    "token_cube": f"""
        with counted as (select lang, {_SPLIT_SQL} as split, {_COUNT_SQL} as n_tokens from documents)
        select lang, split, cast(grouping_id(lang, split) as bigint) as grouping, count(*) as n_rows,
          cast(sum(n_tokens) as bigint) as n_tokens, cast(sum(n_tokens) // {SHORT} as bigint) as full_samples,
          cast(sum(n_tokens) // {SHORT} // 64 as bigint) as full_batches
        from counted group by grouping sets ((lang, split), (lang), (split), ())""",
    "flatten_nested": """
        with opened as (
          select doc_id, lang, unnest(string_split(text, chr(10))) as line_text,
            generate_subscripts(string_split(text, chr(10)), 1) as i
          from documents)
        select doc_id, lang as language, cast(i as integer) as line_number, line_text,
          cast(length(line_text) as integer) as line_chars
        from opened""",
    "response_comparison": f"""
        select a.doc_id, a.lang, a.text as answer_a, b.answer_b
        from documents a
        join (select doc_id, array_to_string({TOKENS_SQL}, ' ') as answer_b from documents) b
          on a.doc_id = b.doc_id""",
    "map_text": "select doc_id, text, replace(text, 'e', '3') as mapped from documents",
}
