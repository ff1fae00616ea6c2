"""Articles of pages, nested records, answers side by side, the user's own function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.chat import DEFAULT_SYSTEM, chat_messages
from corpusprep.functions.html import article_fields
from corpusprep.operators.ordering import names

#: Texts that are Python objects at a time.
TEXTS_AT_ONCE = 512


def extract_article(df: DataFrame, html_col: str = "html", paragraphs: bool = True) -> DataFrame:
    """The page rows with ``title`` and ``text`` in place of their HTML, the text in
    paragraphs (an empty line between them) or as one line. They come
    out of a generator, so a later filter uses the finished columns; through a
    plain projection it would be pushed down and run every expression again."""
    kept = [c for c in df.columns if c != html_col]
    return df.select(*kept, F.inline(article_fields(html_col, paragraphs)))


def flatten_nested(
    df: DataFrame, array_col: str, parent_cols: Mapping[str, str] | Sequence[str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per element of ``array_col``: the parent's columns, then the
    element's fields. ``renames`` gives fields their display names; without it
    all fields keep theirs. A parent with an empty or null array gives no row."""
    if not isinstance(parent_cols, Mapping):
        parent_cols = {c: c for c in parent_cols}
    parents = [F.col(c).alias(name) for c, name in parent_cols.items()]
    if renames is None:
        return df.select(*parents, F.inline(array_col))
    fields = [F.col("_element")[f].alias(name) for f, name in renames.items()]
    opened = df.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(parent_cols)], F.explode(array_col).alias("_element"))
    renamed = [F.col(f"_p{i}").alias(name) for i, name in enumerate(parent_cols.values())]
    return opened.select(*renamed, *fields)


def exchange_messages(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", system: str = DEFAULT_SYSTEM
) -> DataFrame:
    """A chat record (``messages``) for each user turn that an assistant turn follows:
    the conversation's first system turn or else ``system``, the user's turn, the
    answer. Equi-joins on the conversation and its turns, nothing is collected, so a
    conversation of any size is many records. Turns tell a conversation's rows apart."""
    user = df.filter(F.col(role) == "user").select(key, turn, F.col(text).alias("_prompt"))
    answer = df.filter(F.col(role) == "assistant").select(key, (F.col(turn) - 1).alias(turn), F.col(text).alias("_answer"))
    first = df.filter(F.col(role) == "system").groupBy(key).agg(F.min_by(text, turn).alias("_system"))
    pairs = user.join(answer, [key, turn]).join(first, key, "left")
    return pairs.select(key, turn, chat_messages("_prompt", "_answer", F.coalesce("_system", F.lit(system))).alias("messages"))


def compare_responses(
    a: DataFrame,
    b: DataFrame,
    key: str | Sequence[str],
    content: str = "content",
    a_name: str = "answer_a",
    b_name: str = "answer_b",
) -> DataFrame:
    """The answers of two models to the same prompts, next to each other, with
    the other columns of ``a``. ``b`` has one answer per key: a second one stops
    the job, so that no key can make pairs of all its rows. Keys alone are counted,
    before their shuffle; no aggregate holds an answer."""
    keys = names(key)
    left = a.withColumnRenamed(content, a_name)
    counts = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    answers = b.select(*keys, F.col(content).alias("_answer")).join(counts.hint("shuffle_hash"), keys)
    stop = F.raise_error(F.lit(f"a second answer for the same {keys}"))
    right = answers.select(*keys, F.when(F.col("_n") > 1, stop).otherwise(F.col("_answer")).alias(b_name))
    return left.join(right, keys, "inner")


def map_text(df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series], out: str) -> DataFrame:
    """Adds ``fn`` of a text column. ``fn`` gets the texts of a part of an Arrow batch, at
    most TEXTS_AT_ONCE, as a Series without nulls, and returns as many; null stays null."""

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                texts = batch.slice(at, TEXTS_AT_ONCE).to_pandas()
                known = texts.notna()
                mapped = pd.Series([None] * len(texts), index=texts.index, dtype=object)
                mapped[known] = fn(texts[known])
                yield pa.Array.from_pandas(mapped, type=pa.large_string() if pa.types.is_large_string(batch.type) else pa.string())
            pa.default_memory_pool().release_unused()

    return df.withColumn(out, F.arrow_udf(apply, "string")(F.col(column)))
