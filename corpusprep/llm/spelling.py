"""Spelling variants: words that differ by one inserted, deleted or replaced character.

A word and a terminator have a rotation for every character. The one that ends with the
character at hand, cut before it, is a prefix that skips this character: all words that
differ in it alone have the same prefix, and so has the rotation of the word that lacks
it, as a whole. All rotations are therefore (prefix, last character), the last being
empty for a whole rotation. Spark deals them by prefix and sorts them inside by count
and character; a scan of each group counts neighbours and hands every word its
neighbour of largest count. That takes the group's size and its first two rows only:
no pairs are made. A group holds one row per character of the alphabet at most, and one
whole rotation.

A replaced character is found in one group. An inserted one is found once for each
place of a run of equal characters (``aab`` and ``ab``): it is counted at the first.

Words carry their rank in code-point order, so that ties need no texts. Prefixes of up
to ``PLAIN`` characters are sorted as they are; a longer one has a name of 128 bits made
from its two ends (polynomial hashes), so that a word of a million letters is a
million short rows.

Defined results: null and empty texts have no words; a null key counts as the text
``null``; equal rows count as often as they are there; an empty table gives no rows;
columns other than the two named are not read and may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import give_back_memory, shuffle_tasks, stored
from corpusprep.llm.hashing import Names, mix

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as its variant.
TIMES = 10
#: Of so many pairs of document and word one loses a character (see ``count_words``).
EDIT_EVERY = 31
END = "\x00"
PLAIN = 64
#: Distinct words that a task counts before it sends them.
WORDS_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 1 << 15


def _counts(least: int, every: int | None):
    # Lower-cased are only A to Z, as in bytes; runs are letters of ASCII and U+00C0 to U+00FF.
    find = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall

    def send(counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
        words, numbers = list(counts), list(counts.values())
        for i in range(0, len(words), ROWS_AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(words[i : i + ROWS_AT_ONCE], pa.string()), pa.array(numbers[i : i + ROWS_AT_ONCE], pa.int64())], names=["word", "n"])

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                here: dict[str, int] = {}
                for word in find(text.as_py().lower().decode()):
                    here[word] = here.get(word, 0) + 1
                start = zlib.crc32(f"{key}:".encode())
                for word, n in here.items():
                    if every:
                        h = zlib.crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > WORDS_AT_ONCE:
                    yield from send(counts)
                    counts = {}
        yield from send(counts)
        give_back_memory()

    return run


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, edit_every: int | None = None) -> DataFrame:
    """``word, n``: the runs of letters of at least ``least`` characters, and how often
    they occur. With ``edit_every``, a run whose crc32 of ``<key>:<run>`` it divides loses
    one character first, which plants misspellings."""
    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_counts(least, edit_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _long_names(word: str) -> tuple[list[str], list[str]]:
    """Names of the prefixes of a long word: without each character, and whole."""
    codes = mix(np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1))
    n = len(codes)
    at, cut = np.arange(n), np.arange(n + 1)

    def join(lo, hi):
        ends = []
        for which in (0, 1):
            name = Names(codes, which)
            left = name(np.zeros(len(lo), np.int64), lo)
            ends.append(mix(left * np.uint64(3) + mix(name(hi, np.full(len(hi), n)) + np.uint64(which + 1))))
        return [f"\x01{a:016x}{b:016x}" for a, b in zip(*(e.tolist() for e in ends), strict=True)]

    return join(at, at + 1), join(cut, cut)


def _rotate(batches):
    def send(rows):
        prefix, last, ids, n, first = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(prefix, pa.string()), pa.array(last, pa.string()), pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.bool_())],
            names=["prefix", "last", "id", "n", "first"],
        )

    rows: list[tuple] = []
    for batch in batches:
        for key, word, n in zip(batch["id"].to_pylist(), batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
            size = len(word)
            doubled = word + END + word
            # A prefix that skips a character has as many as the word; a whole rotation has one more.
            if size <= PLAIN:
                skips = [doubled[i + 1 : i + 1 + size] for i in range(size)]
            if size < PLAIN:
                wholes = [doubled[i : i + 1 + size] for i in range(size + 1)]
            if size >= PLAIN:
                named, wholes = _long_names(word)
                skips = named if size > PLAIN else skips
            before = ""
            for p, c in zip(skips, word, strict=True):
                rows.append((p, c, key, n, c != before))
                before = c
            rows += [(p, "", key, n, False) for p in wholes]
            while len(rows) >= ROWS_AT_ONCE:
                yield send(rows[:ROWS_AT_ONCE])
                rows = rows[ROWS_AT_ONCE:]
    if rows:
        yield send(rows)
    give_back_memory()


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, id, n, first`` for every rotation of ``id, word, n``. ``first``: the
    last character is the first of its run in the word."""
    return words.mapInArrow(_rotate, "prefix string, last string, id long, n long, first boolean")


def ranked(words: DataFrame) -> DataFrame:
    """Stored ``id, word, n``; ids follow the words' code-point order."""
    tasks = shuffle_tasks(words.sparkSession)
    words = stored(words, "words")  # the range bounds are drawn from it
    rows = words.repartitionByRange(tasks, "word").sortWithinPartitions("word")
    return stored(rows.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "ranked-words")


def neighbours(words: DataFrame) -> DataFrame:
    """``id, n_near`` and the neighbour of largest count, ``best_n, best`` (an id; of
    ties the smallest), for every word of ``id, word, n`` that has a neighbour."""
    whole = F.col("last") == ""
    group = W.partitionBy("prefix")
    # Words first, by count; the group's whole rotation, if there, is its last row.
    order = group.orderBy(whole, F.col("n").desc(), "last").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    one = F.struct((-F.col("n")).alias("n"), F.col("id").alias("id"))
    rows = rotations(words).select(
        "*",
        F.row_number().over(group.orderBy(whole, F.col("n").desc(), "last")).alias("place"),
        F.sum(F.when(whole, 0).otherwise(1)).over(order).alias("members"),
        F.sum(F.when(F.col("first"), 1).otherwise(0)).over(order).alias("firsts"),
        F.max(F.when(whole, one)).over(order).alias("shorter"),
        F.first(one).over(order).alias("top"),
        F.nth_value(one, 2).over(order).alias("next"),
    )
    rows = rows.filter((F.col("members") > 1) | (F.col("shorter").isNotNull() & (F.col("members") > 0)))
    other = F.when(F.col("members") > 1, F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top")))
    near = F.when(whole, F.col("firsts")).otherwise(F.col("members") - 1 + F.when(F.col("shorter").isNotNull() & F.col("first"), 1).otherwise(0))
    best = F.when(whole, F.col("top")).otherwise(F.least(other, F.col("shorter")))
    found = rows.groupBy("id").agg(F.sum(near).alias("n_near"), F.min(best).alias("best"))
    return found.select("id", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.id").alias("best"))


def variant_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``word, n``: its form is
    the neighbour of largest count, if that is ``times`` its own at least; its root is
    where forms of forms end."""
    if times < 2:
        raise ValueError("a form must be at least twice as frequent, or chains may not end")
    words = ranked(words)
    near = stored(neighbours(words), "neighbours")
    joined = words.join(near, "id", "left")
    has = F.col("best_n") >= times * F.col("n")
    links = stored(joined.filter(has).select("id", F.col("best").alias("form"), F.col("best_n").alias("form_n")), "forms")
    # A step multiplies the count by ``times``: chains are short, and each round doubles
    # the length that is followed.
    most, steps = words.agg(F.max("n")).first()[0] or 1, 0
    while most >= times:
        most, steps = most // times, steps + 1
    roots, reach = links.select("id", F.col("form").alias("root")), 1
    while reach < steps:
        on = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
        reach *= 2
    text = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    named = links.join(roots, "id").join(text("form"), "form").join(text("root"), "root").select("id", "form_word", "root_word", "form_n")
    out = words.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return out.select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


def spelling_variants(df: DataFrame, key: str = "doc_id", text: str = "text", edit_every: int | None = None) -> DataFrame:
    """The words of the texts with at least LEAST_COUNT occurrences, with their groups."""
    return variant_groups(count_words(df, key, text, edit_every=edit_every).filter(F.col("n") >= LEAST_COUNT))


def variants_sql() -> str:
    """The same in SQL for DuckDB; crc32 byte by byte, neighbours as pairs."""
    step = "case when {c} & 1 = 1 then xor({c} >> 1, 3988292384) else {c} >> 1 end"
    entry = "n"
    for i in range(8):
        entry = f"(select {step.format(c='c')} from (select {entry} as c) t{i})"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with recursive crc_table as (select list(e order by n) as t from (select n, {entry} as e from (select unnest(range(256))::bigint as n))),
runs as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{upper}', '{lower}') as run from documents),
counted as (select doc_id, run, count(*) as c from runs where length(run) >= {LEAST_LENGTH} group by all),
hashed as (select run, c, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(coalesce(cast(doc_id as varchar), 'null') || ':' || run)), '..'), lambda x: cast('0x' || x as bigint))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as h from counted, crc_table),
edited as (select case when h % {EDIT_EVERY} = 0 then run[: h % length(run)] || run[h % length(run) + 2 :] else run end as word, c from hashed),
words as (select word, cast(sum(c) as bigint) as n from edited where length(word) >= {LEAST_LENGTH} group by word having sum(c) >= {LEAST_COUNT}),
places as (select word, n, unnest(range(length(word))) as i from words),
skips as (select word, n, i, word[: i] as a, word[i + 2 :] as b from places),
pairs as (select x.word, y.word as other, y.n as m from skips x join skips y on x.a = y.a and x.b = y.b and x.word <> y.word
  union select x.word, v.word, v.n from skips x join words v on v.word = x.a || x.b
  union select v.word, x.word, x.n from skips x join words v on v.word = x.a || x.b),
near as (select word, count(*) as n_near, max(m) as best_n, arg_min(other, (-m, other)) as best from pairs group by word),
forms as (select word, n, coalesce(n_near, 0) as n_near, case when best_n >= {TIMES} * n then best end as form, case when best_n >= {TIMES} * n then best_n end as form_n
  from words left join near using (word)),
chain as (select word, word as root from forms where form is null
  union all select f.word, c.root from forms f join chain c on f.form = c.word)
select word, form, root, n, n_near, form_n from forms join chain using (word)"""
