"""Tokens of a text: split at blanks, or by a tokenizer file."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.strings import _col

# Fixed value: the text that ends a document.
DEFAULT_EOS = "<|endoftext|>"

_BLANKS = r"[ \t\n\r\f]+"
MAX_TOKENIZER_BYTES = 64 * 1024 * 1024


def whitespace_tokens(text: Column | str) -> Column:
    """The runs of non-blank characters. ``array_remove`` drops the empty ends
    and stays in generated code, which a lambda filter would not."""
    return F.array_remove(F.split(_col(text), _BLANKS), "")


def count_tokens(text: Column | str) -> Column:
    """How many ``whitespace_tokens`` a text has, without an array of them."""
    return F.regexp_count(_col(text), F.lit(r"[^ \t\n\r\f]+")).cast("bigint")


def with_eos(tokens: Column | str, eos: str | int = DEFAULT_EOS) -> Column:
    """The tokens and, after the last, the end-of-text token."""
    return F.concat(_col(tokens), F.array(F.lit(eos)))


def file_tokenizer(spark: SparkSession, path: str) -> Callable[[Column | str], Column]:
    """A function from a text column to token ids (ARRAY<INT>), by a local
    ``tokenizer.json``. Its bytes are broadcast, after a check of their size;
    each task builds the tokenizer once and runs over Arrow batches."""
    size = os.path.getsize(path)
    if size > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than {MAX_TOKENIZER_BYTES}")
    with open(path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Spark already runs one task per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition.value)
        for texts in batches:
            known = texts.notna()
            ids = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            encoded = tokenizer.encode_batch(texts[known].tolist(), add_special_tokens=False)
            ids[known] = pd.Series([e.ids for e in encoded], index=texts.index[known], dtype=object)
            yield ids

    encode_udf = F.pandas_udf(encode, "array<int>")
    return lambda text: encode_udf(_col(text))
