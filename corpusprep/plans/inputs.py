"""The given tables in the shapes the operators expect, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from corpusprep.functions.html import ENTITIES, LINES, PARAGRAPHS, REFERENCE
from corpusprep.operators import extract_article
from corpusprep.sources import read_table

# Code elements, from the part table. The same text runs in both engines.
_CODE_COLUMNS = [
    "p_partkey",
    "case p_partkey % 4 when 0 then 'class' when 1 then 'method' else 'function' end as element_type",
    "case when p_size % 7 = 0 then '' when p_size % 11 = 0 then null else 'a, b' end as args",
    "case when p_size % 5 = 0 then null"
    " when p_size % 3 = 0 then concat('Short note on ', p_name)"
    " else concat('Compute ', p_name, chr(10), 'Parameters', chr(10), '----------') end as doc_string",
    "case when p_size % 13 = 0 then concat('def fn_', cast(p_partkey as varchar(20)), '(a, b): pass')"
    " else concat('def fn_', cast(p_partkey as varchar(20)), '(a, b):', chr(10),"
    " '    \"\"\"', p_name, '\"\"\"', chr(10), '    return a') end as source",
]
CODE_SQL = f"select {', '.join(_CODE_COLUMNS)} from part"

# The same on well-formed pages, step by step, in DuckDB's syntax.
_VISIBLE_SQL = r"regexp_replace(html, '(?is)<(?:script\b.*?(?:</script>|\z)|style\b.*?(?:</style>|\z)|!--.*?(?:-->|\z))', '{}', 'g')"


def _decoded_sql(text: str) -> str:
    """References decoded part by part, as the code does it."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = "map {" + ", ".join(f"{quoted(n)}: {quoted(c)}" for n, c in ENTITIES.items()) + "}"
    name = f"regexp_extract(p, '{REFERENCE}', 1)"
    code = f"case when {name} ~ '#[xX].*' then cast('0x' || substr({name}, 3) as bigint) when {name} ~ '#.*' then cast(substr({name}, 2) as bigint) end"
    known = f"({code} between 1 and 55295 or {code} between 57344 and 1114111)"
    char = f"coalesce({table}[{name}], case when {known} then chr(cast({code} as integer)) end)"
    part = f"case when {char} is null then '&' || p else {char} || substr(p, length({name}) + 2) end"
    pieces = f"string_split({text}, '&')"
    return f"({pieces}[1] || array_to_string(list_transform({pieces}[2:], lambda p: {part}), ''))"


_TITLE_SQL = rf"""regexp_replace(regexp_extract({_VISIBLE_SQL.format(" ")}, '(?is)\A.*?<title\b[^<>]*>(.*?)</title>', 1), '<[^<>]*>', ' ', 'g')"""
_TITLE_SQL = rf"trim(regexp_replace({_decoded_sql(_TITLE_SQL)}, '[ \t\n\r\f]+', ' ', 'g'))"
_TEXT_SQL = rf"regexp_extract({_VISIBLE_SQL.format('')}, '(?is)\A.*?<article\b[^<>]*>(.*?)</article>', 1)"
for _pattern, _by in (
    (rf"(?i)</?(?:{'|'.join(PARAGRAPHS.split())})\b[^<>]*>", "\x03"),
    (rf"(?i)</?(?:{'|'.join(LINES.split())})\b[^<>]*>", "\x04"),
    (r"<[^<>]*>", ""),
    (r"[ \t\n\r\f]+", " "),
    (r"[ \x04]*\x03[ \x03\x04]*", "\n\n"),
    (r" *\x04[ \x04]*", "\n"),
):
    _TEXT_SQL = f"regexp_replace({_TEXT_SQL}, '{_pattern}', '{_by}', 'g')"
_TEXT_SQL = f"trim({_decoded_sql(_TEXT_SQL)}, ' \n')"
ARTICLES_SQL = f"select page_id, url, {_TITLE_SQL} as title, {_TEXT_SQL} as text from pages"

TOKENS_SQL = r"list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> '')"


def split_sql(seed: int, key: str, splits: Mapping[str, float]) -> str:
    """The split of a row: by the first 32 bits of a digest."""
    draw = f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::bigint"
    ends, so_far = [], 0.0
    for name, weight in splits.items():
        so_far += weight
        ends.append(f"when {draw} < {round(so_far / sum(splits.values()) * 4294967296)} then '{name}'")
    return f"case {' '.join(ends)} end"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, "documents", folder)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, "events", folder)


def code_elements(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, "part", folder).selectExpr(*_CODE_COLUMNS)


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return extract_article(read_table(spark, "pages", folder))
