"""Quality rules: a table of thresholds, compiled into one projection.

Every measure is a built-in expression over the words and lines of one row, so
the rows never leave their task. Rules compare whole numbers, hence SQL and Spark
agree to the last digit.

Defined results: null text counts as empty (no words, fails ``words_min``); a
null or repeated ``doc_id`` is carried through, one row out for each row in;
columns other than the two named ones are not read, whatever their names; an
empty table gives no rows; texts of any length are one row's work.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import let, words_of

WINDOW = 8

#: Function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the and of to in is that it for with as was are be this on by from "
    "der die das und den von zu mit ist im des dem ein für über als nicht "
    "le la les et de du un une en que qui pour dans par est sur "
    "el los las y del se por con una es lo no como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A row fails when ``100 * measure`` is below ``low`` or above ``high`` percent
    of ``per``; the rule holds for rows with at least ``from_words`` words."""

    name: str
    measure: str
    per: str
    low: int | None = None
    high: int | None = None
    base: bool = False
    from_words: int = 1


#: ``one`` is the constant 1, so 2000 percent of it are 20 words.
RULES = (
    Rule("words_min", "n_words", "one", low=2000, base=True, from_words=0),
    Rule("repeated_words", "n_repeat_words", "n_words", high=30, base=True),
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("capitals", "n_capitals", "word_chars", high=40),
    Rule("stop_words", "n_stop_words", "n_words", low=1, high=90, from_words=200),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=50),
)

MEASURES = (
    "n_words word_chars n_symbols n_capitals n_stop_words n_lines n_dup_lines n_ellipsis_lines n_repeat_words"
).split()


def _covered(places: Column) -> Column:
    """Words under windows that start at these rising places."""
    gaps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def _repeats(windows: Column) -> Column:
    """Words under windows that are there twice; windows are 64-bit hashes."""

    def count(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            before = F.transform(s, lambda e, j: F.when(j > 0, F.get(s, j - 1)["h"]))
            same = F.zip_with(s, before, lambda e, b: F.coalesce(e["h"] == b, F.lit(False)))
            return let(same, lambda m: F.sort_array(F.filter(F.transform(s, lambda e, j: F.when(F.get(m, j) | F.coalesce(F.get(m, j + 1), F.lit(False)), e["i"])), lambda i: i.isNotNull())))

        return let(let(ordered, places), _covered)

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), count(h)).otherwise(0))


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    windows = lambda w: F.when(
        F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def of_words(w: Column) -> Column:
        def of_lines(x: Column) -> Column:
            found = {
                "n_words": F.size(w),
                "word_chars": F.length(F.array_join(w, "")),
                "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
                "n_capitals": F.regexp_count(text, F.lit(r"[A-Z]")),
                "n_stop_words": F.size(F.filter(w, lambda v: v.isin(STOP_WORDS))),
                "n_lines": F.size(x),
                "n_dup_lines": F.size(x) - F.size(F.array_distinct(x)),
                "n_ellipsis_lines": F.size(F.filter(x, lambda v: v.endswith("...") | v.endswith("…"))),
                "n_repeat_words": _repeats(windows(w)),
            }
            return F.struct(*(found[k].cast("long").alias(k) for k in MEASURES))

        return let(lines, of_lines)

    return let(words_of(text), of_words)


def failed(rule: Rule, inside: str = "") -> Column:
    """The rule's verdict over columns, or over the fields of a struct ``inside``."""
    value, per = F.col(inside + rule.measure) * 100, F.lit(1) if rule.per == "one" else F.col(inside + rule.per)
    sides = [value < per * rule.low] if rule.low is not None else []
    sides += [value > per * rule.high] if rule.high is not None else []
    return (F.col(inside + "n_words") >= rule.from_words) & reduce(Column.__or__, sides)


def apply_rules(df: DataFrame, text: str = "text", key: str = "doc_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each row: the measures, the first rule that fails (null if none),
    ``base_failed`` (a rule marked so fails) and ``kept`` (none fails)."""
    rows = df.select(key, measures(F.col(text)).alias("_m")).select(key, "_m.*")
    names = F.filter(F.array(*(F.when(failed(r), F.lit(r.name)) for r in rules)), lambda n: n.isNotNull())
    base = reduce(Column.__or__, [failed(r) for r in rules if r.base], F.lit(False))
    return rows.withColumns({"failed_rule": F.get(names, 0), "base_failed": base, "kept": F.size(names) == 0})


def good_documents(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with their columns as they were."""
    rejected = reduce(Column.__or__, [failed(r, "__measures.") for r in rules])
    return df.withColumn("__measures", measures(F.col(text))).filter(~rejected).drop("__measures")


def _sql_failed(rule: Rule) -> str:
    per = "1" if rule.per == "one" else rule.per
    sides = [f"100 * {rule.measure} < {rule.low} * {per}"] if rule.low is not None else []
    sides += [f"100 * {rule.measure} > {rule.high} * {per}"] if rule.high is not None else []
    return f"(n_words >= {rule.from_words} and ({' or '.join(sides)}))"


def measures_sql(table: str = "documents") -> str:
    """The measures of every row of a table, for DuckDB."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
with q9_rows as (
  select row_number() over () as rid, * replace (coalesce(text, '') as text), text as raw_text from {table}),
q9_words as (
  select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from q9_rows),
q9_windows as (
  select rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as s
  from (select rid, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) as i from q9_words where len(w) >= {WINDOW})),
q9_twice as (select rid, i from (select rid, i, count(*) over (partition by rid, s) as n from q9_windows) where n > 1),
q9_cover as (select rid, count(distinct p) as n from (select rid, i + unnest(range({WINDOW})) as p from q9_twice) group by rid),
q9_measures as (
  select q9_words.*, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals,
    len(list_filter(w, lambda x: x in ({stops}))) as n_stop_words,
    len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines,
    len(list_filter(ls, lambda x: ends_with(x, '...') or ends_with(x, '…'))) as n_ellipsis_lines,
    coalesce(q9_cover.n, 0) as n_repeat_words
  from q9_words left join q9_cover using (rid))"""


def rules_sql(table: str = "documents", rules: Sequence[Rule] = RULES) -> str:
    base = " or ".join(_sql_failed(r) for r in rules if r.base)
    every = " or ".join(_sql_failed(r) for r in rules)
    first = " ".join(f"when {_sql_failed(r)} then '{r.name}'" for r in rules)
    columns = ", ".join(f"cast({m} as bigint) as {m}" for m in MEASURES)
    return f"{measures_sql(table)} select doc_id, {columns}, case {first} end as failed_rule, ({base}) as base_failed, not ({every}) as kept from q9_measures"


def good_documents_sql(table: str, rules: Sequence[Rule] = RULES) -> str:
    every = " or ".join(_sql_failed(r) for r in rules)
    return f"{measures_sql(table)} select doc_id, raw_text as text, lang, source, n_chars from q9_measures where not ({every})"
