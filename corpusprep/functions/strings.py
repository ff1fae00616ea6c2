"""File names, function signatures, prompts and digests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DOCSTRING_QUOTES = '"""'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """The part after the last ``/``; all of it when there is none."""
    return F.substring_index(_col(path), "/", -1)


def file_stem(path: Column | str) -> Column:
    """``base_name`` with every ``.`` turned into ``_``."""
    return F.translate(base_name(path), ".", "_")


def unique_stem(path: Column | str) -> Column:
    """``file_stem`` plus 16 hex digits of the whole id, so that ids which share
    a stem get names of their own. Row-wise: no join against the other names."""
    digest = F.substring(F.sha2(_col(path).cast("string"), 256), 1, 16)
    return F.concat(file_stem(path), F.lit("-"), digest)


def file_path(folder: str, stem: Column | str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), _col(stem), F.lit(".txt"))


def function_signature(source: Column | str, missing: str = "keep") -> Column:
    """Source text up to the first triple quote.

    Without a triple quote, ``keep`` returns the whole source and ``compat``
    drops its last character, as slicing up to position -1 does.
    """
    source = _col(source)
    before = F.substring_index(source, DOCSTRING_QUOTES, 1)
    if missing == "keep":
        return before
    if missing == "compat":
        shortened = F.left(source, F.greatest(F.length(source) - 1, F.lit(0)))
        return F.when(F.instr(source, DOCSTRING_QUOTES) > 0, before).otherwise(shortened)
    raise ValueError(f"missing must be 'keep' or 'compat', not {missing!r}")


@dataclass(frozen=True)
class PromptText:
    """The fixed lines around the input, shared by training and inference."""

    instruction: str
    input_key: str
    response_key: str


# The default prompt lines; pass a PromptText to use others.
DOCSTRING_PROMPT = PromptText(
    instruction="The following is a pyspark function definition. "
    "Write a numpy style docstring for the provided function definition.",
    input_key="### Function definition",
    response_key="### Numpy style docstring",
)
TITLE_PROMPT = PromptText(
    instruction="The following is the text of a blog post. Create a title for the provided blog post.",
    input_key="### Blog:",
    response_key="### Title:",
)


def instruction_prompt(text: Column | str, lines: PromptText) -> Column:
    """Instruction, input key, text and response key, each on lines of their own."""
    return F.concat(
        F.lit(f"{lines.instruction}\n{lines.input_key}\n"),
        _col(text),
        F.lit(f"\n{lines.response_key}\n"),
    )


def seeded_md5(seed: int, *key: Column | str) -> Column:
    """md5 of ``seed:key``: the same for a row wherever it lies."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in key]))


def content_digest(*columns: Column | str) -> Column:
    """256-bit digest of several columns. Each is hashed first, so that values
    cannot run into each other; null and the empty string differ."""
    parts = [F.coalesce(F.sha2(_col(c).cast("string"), 256), F.lit("null")) for c in columns]
    return parts[0] if len(parts) == 1 else F.sha2(F.concat_ws(":", *parts), 256)
