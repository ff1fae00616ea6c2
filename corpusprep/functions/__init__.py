"""Column expressions. All but the tokenizer file and the user hook are native."""

from corpusprep.functions.chat import (
    CHAT_SCHEMA,
    DEFAULT_SYSTEM,
    ROLES,
    chat_fault,
    chat_json,
    chat_message,
    chat_messages,
    pair_json,
    with_system,
)
from corpusprep.functions.html import article_fields, article_text, page_title
from corpusprep.functions.strings import (
    DOCSTRING_PROMPT,
    TITLE_PROMPT,
    PromptText,
    base_name,
    content_digest,
    file_path,
    file_stem,
    function_signature,
    instruction_prompt,
    seeded_md5,
    unique_stem,
)
from corpusprep.functions.tokens import DEFAULT_EOS, count_tokens, file_tokenizer, whitespace_tokens, with_eos

__all__ = [
    "CHAT_SCHEMA",
    "DEFAULT_EOS",
    "DEFAULT_SYSTEM",
    "DOCSTRING_PROMPT",
    "PromptText",
    "TITLE_PROMPT",
    "article_fields",
    "article_text",
    "base_name",
    "ROLES",
    "chat_fault",
    "chat_json",
    "chat_message",
    "chat_messages",
    "content_digest",
    "count_tokens",
    "file_path",
    "file_stem",
    "file_tokenizer",
    "function_signature",
    "instruction_prompt",
    "page_title",
    "pair_json",
    "seeded_md5",
    "unique_stem",
    "whitespace_tokens",
    "with_eos",
    "with_system",
]
