"""URL rules: a blocked Bloom filter in front of an exact hash join.

Built-in functions only. A rule is ``host`` followed by a path prefix, such as
``example.net/en/``. It fits its host and all subdomains, if the url's path starts
with the rule's; the longest rule that fits wins.

Every url gives one candidate key for each shape (labels of the host, characters
of the path) that the list holds. A candidate looks at one block of the filter,
256 bits, of which 8 must be set. Only candidates that pass reach the join, which
removes the false hits.

What is sent to all tasks: the filter, at most ``MAX_BLOCKS`` rows of five numbers
whatever the length of the list (a longer list gets more false hits, never a wrong
result); and the list itself, if it was counted to be below ``MAX_LIST_CHARS``.
A longer list is joined by a shuffle in which every rule is there ``SALTS`` times,
so a rule that a third of all urls meet is met in ``SALTS`` tasks or more.

Defined results: null, or without ``://``: host and path empty, no rule, ``allow``.
Repeated rows come out as often as they came in, a null ``page_id`` as null. Two
rules with equal text: ``block`` wins. Rules with an empty host are left out. Other
columns are not read. Empty tables give no rows; without rules all is allowed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_RULE = 16
BLOCK_BITS = 256
MAX_BLOCKS = 1 << 16
MAX_LIST_CHARS = 4_000_000
SALTS = 32
DEFAULT_VERDICT = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """``rule`` (host lower-cased, then path), its ``labels`` and ``path_chars``, and
    ``verdict``; one row for each rule."""
    host = ascii_lower(F.regexp_extract("rule", r"^[^/]*", 0))
    path = F.regexp_extract("rule", r"^[^/]*(.*)$", 1)
    return (
        rules.select(F.concat(host, path).alias("rule"), _labels(host).alias("labels"), F.length(path).alias("path_chars"), F.length(host).alias("_h"), "verdict")
        .filter("_h > 0")
        .groupBy("rule", "labels", "path_chars")
        .agg(F.max("verdict").alias("verdict"))
    )


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and, for each of its four words, the two bits to set."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit(1))

    def bit(i: int) -> Column:
        at = F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return F.pmod(h, F.lit(blocks)).cast("int"), [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(4)]


def bloom_blocks(rules: DataFrame, n_rules: int) -> tuple[DataFrame, int]:
    """The filter as rows (block, w0, w1, w2, w3), without empty blocks, and how many
    blocks there are."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n_rules * BITS_PER_RULE / BLOCK_BITS))))
    blocks = min(blocks, MAX_BLOCKS)
    block, words = _place(F.col("rule"), blocks)
    rows = rules.select(block.alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4))), blocks


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Judges every row of ``pages``: key, host, path, rule and verdict. ``rules`` has
    ``rule`` and ``verdict``."""
    rules = canonical_rules(rules)
    stats = rules.agg(F.count("*"), F.sum(F.length("rule")), F.collect_set(F.struct("labels", "path_chars"))).first()
    n_rules, chars, shapes = stats[0], stats[1] or 0, stats[2]
    # Equal rows are judged once.
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("_url")).groupBy("page_id", "_url").agg(F.count("*").alias("_n"))
    host, path = host_and_path(F.col("_url"))
    judged = rows.select("*", host.alias("host"), path.alias("path"))
    if not n_rules:
        judged = judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT_VERDICT).alias("verdict"))
    else:
        judged = judged.join(_hits(rules, n_rules, chars, shapes, judged), [judged["page_id"].eqNullSafe(F.col("_k")), judged["_url"] == F.col("_u")], "left").select(
            *judged.columns, "rule", F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("verdict")
        )
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))
    return judged.select("*", again.alias("_i")).select(F.col("page_id").alias(key), "host", "path", "rule", "verdict")


def _hits(rules: DataFrame, n_rules: int, chars: int, shapes: list, judged: DataFrame) -> DataFrame:
    """For each url with a rule, the longest."""
    blocks, n_blocks = bloom_blocks(rules, n_rules)
    n_labels = _labels(F.col("host"))
    # One constant of numbers, so the plan does not grow with the list.
    wanted = F.split(F.lit(",".join(str((s["labels"] << 32) + s["path_chars"]) for s in sorted(shapes))), ",").cast("array<bigint>")

    def candidate(shape: Column) -> Column:
        labels = F.shiftright(shape, 32).cast("int")
        chars = shape.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        key = F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -labels), F.substring(F.col("path"), F.lit(1), chars))
        return F.when((n_labels >= labels) & (F.length("path") >= chars), key)

    asked = judged.filter("host <> ''").select(F.col("page_id").alias("_k"), F.col("_url").alias("_u"), F.explode(F.array_compact(F.transform(wanted, candidate))).alias("_key"))
    block, words = _place(F.col("_key"), n_blocks)
    asked = asked.select("*", block.alias("_block"), *(w.alias(f"_w{i}") for i, w in enumerate(words)))
    set_bits = [F.col(f"_w{i}").bitwiseAND(F.col(f"w{i}")) == F.col(f"_w{i}") for i in range(4)]
    possible = asked.join(F.broadcast(blocks), [F.col("_block") == F.col("block"), *set_bits]).select("_k", "_u", "_key")
    if chars <= MAX_LIST_CHARS:
        found = possible.join(F.broadcast(rules), possible["_key"] == rules["rule"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = rules.select("*", salts.alias("_salt"))
        possible = possible.withColumn("_salt", F.pmod(F.xxhash64("_k", "_u"), F.lit(SALTS)).cast("int"))
        found = possible.join(salted, (possible["_key"] == salted["rule"]) & (possible["_salt"] == salted["_salt"]))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("labels")))
    return found.groupBy("_k", "_u").agg(best.alias("_b")).select("_k", "_u", "_b.rule", "_b.verdict")


def filter_sql(rules: dict[str, str]) -> str:
    """The same verdicts in SQL for DuckDB."""
    listed = ", ".join(f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}', '{v}')" for r, v in rules.items())
    return f"""
with u as (select page_id, url, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select row_number() over () as rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(rhost, rpath, rule, verdict) as (values {listed}),
hits as (select rid, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by rid)
select page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') as verdict from p left join hits using (rid)"""
