"""Chat records and prompt/response lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.strings import _col

CHAT_SCHEMA = "messages ARRAY<STRUCT<role: STRING, content: STRING>>"

# Fixed value: the system turn of every record.
DEFAULT_SYSTEM = "A conversation between a user and a helpful assistant."


# The roles of a record.
ROLES = ("system", "user", "assistant")


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def with_system(messages: Column | str, system: str = DEFAULT_SYSTEM) -> Column:
    """The messages with a system turn in front, unless they begin with one."""
    messages = _col(messages)
    has_system = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
    added = F.concat(F.array(_turn("system", F.lit(system))), messages)
    return F.when(has_system, messages).otherwise(added)


def chat_messages(prompt: Column | str, response: Column | str, system: Column | str = DEFAULT_SYSTEM) -> Column:
    """System, user and assistant turns as an array of role and content. ``system`` is a
    text, or a column."""
    return F.array(
        _turn("system", F.lit(system) if isinstance(system, str) else system),
        _turn("user", _col(prompt)),
        _turn("assistant", _col(response)),
    )


def chat_fault(messages: Column | str) -> Column:
    """Why a record cannot be trained on, null if it can: an unknown role, no user turn,
    a last turn that is not the assistant's, or a turn without content."""
    messages = _col(messages)
    has = lambda test: F.coalesce(F.exists(messages, test), F.lit(False))
    last = F.try_element_at(messages, F.lit(-1))["role"]
    return (
        F.when(F.coalesce(F.size(messages), F.lit(0)) < 1, "no turn")
        .when(has(lambda m: ~F.coalesce(m["role"].isin(*ROLES), F.lit(False))), "unknown role")
        .when(~has(lambda m: m["role"] == "user"), "no user turn")
        .when(last != "assistant", "last turn is not the assistant's")
        .when(has(lambda m: F.coalesce(F.trim(m["content"]) == "", F.lit(True))), "empty content")
    )


def _json(record: Column, ascii: bool) -> Column:
    # Without ignoreNullFields=false a null content would lose its key.
    options = {"ignoreNullFields": "false"}
    if ascii:
        options["writeNonAsciiCharacterAsCodePoint"] = "true"
    return F.to_json(record, options)


def chat_json(messages: Column | str, ascii: bool = False) -> Column:
    """One chat record as a JSON line."""
    return _json(F.struct(_col(messages).alias("messages")), ascii)


def chat_message(
    prompt: Column | str, response: Column | str, system: str = DEFAULT_SYSTEM, ascii: bool = False
) -> Column:
    """The chat record of one prompt and response, as a JSON line."""
    return chat_json(chat_messages(prompt, response, system), ascii)


def pair_json(prompt: Column | str, response: Column | str, ascii: bool = False) -> Column:
    """The flat line format: one prompt and one response."""
    return _json(F.struct(_col(prompt).alias("prompt"), _col(response).alias("response")), ascii)
