"""Sharding by a hierarchical weighted hash tree.

A row descends from the root to a region, a rack and a shard. At each level every
child draws ``ln(u) / weight``, u from a hash of the row's key and the child's name,
and the largest draw wins; so a child gets rows in proportion to its weight, and a
change of one weight moves rows only into or out of the subtree where it changed.
A new shard that opens a subtree of its own takes rows only into itself.

The draws are expressions on the row: no shuffle. Slots need one, of narrow rows:
they are numbered inside ranges of a digest, of even size whatever the keys are, and
the ranges' counts are added up.

Defined results: a null key is a key of its own (all such rows share a shard), null
text is empty (size 1), equal rows share a shard and get slots next to each other,
other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_RANGE = 100_000
#: Shards of a rack and of a region in ``even_tree``.
RACK, REGION = 4, 8


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has its number and no children."""

    name: str
    weight: float
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None


def node(name: str, *children: Node) -> Node:
    """An inner node weighs what its children weigh."""
    return Node(name, sum(c.weight for c in children), children)


def even_tree(shards: int, weights: dict[int, float] | None = None, base: int = 16) -> Node:
    """Shards 0 to n - 1, of weight 1 if not given: the first ``base`` four to a rack
    and eight to a region, each later one in a region of its own, so that growing past
    ``base`` by a shard moves rows only into that shard."""
    leaf = lambda s: Node(f"s{s}", (weights or {}).get(s, 1.0), (), s)
    first = min(shards, base)
    racks = [[leaf(s) for s in range(r, min(r + RACK, first))] for r in range(0, first, RACK)]
    racks = [node(f"r{k}", *leaves) for k, leaves in enumerate(racks)]
    step = REGION // RACK
    regions = [racks[k : k + step] for k in range(0, len(racks), step)]
    regions += [[node(f"r{len(racks) + k}", leaf(s))] for k, s in enumerate(range(first, shards))]
    return node("root", *(node(f"g{k}", *members) for k, members in enumerate(regions)))


def _numbered(tree: Node) -> tuple[list[Node], int]:
    """The nodes, the root first, and the number of levels below it."""
    nodes, level, depth = [], [tree], 0
    while level:
        nodes += level
        level = [c for n in level for c in n.children]
        depth += bool(level)
    return nodes, depth


def with_shard(df: DataFrame, key: str, tree: Node, out: str) -> DataFrame:
    """Adds the shard of ``key``, a string column without nulls. The tree is one array
    of constants, so the plan does not grow with it."""
    nodes, depth = _numbered(tree)
    number = {id(n): i for i, n in enumerate(nodes)}
    child = lambda n: F.struct(F.lit(number[id(n)]).alias("i"), F.lit(n.name).alias("name"), F.lit(float(n.weight)).alias("weight"))
    # A shard has itself for a child, so that shards may lie at any depth.
    below = F.array(*(F.array(*(child(c) for c in n.children if c.weight > 0)) if n.children else F.array(child(n)) for n in nodes))
    shards = F.array(*(F.lit(-1 if n.shard is None else n.shard) for n in nodes))

    def draw(c: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(F.col(key), F.lit(":"), c["name"]).cast("binary")), 1, 13), 16, 10).cast("double")
        return F.struct((F.log((bits + 1.0) / float(1 << 52)) / c["weight"]).alias("d"), (-c["i"]).alias("i"))

    at = F.lit(0)
    for level in range(depth):
        df = df.withColumn(f"_{out}{level}", -F.array_max(F.transform(F.get(below, at), draw))["i"])
        at = F.col(f"_{out}{level}")
    return df.withColumn(out, F.get(shards, at)).drop(*(f"_{out}{level}" for level in range(depth)))


def assign_shards(df: DataFrame, tree: Node, grown: Node, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot
    (gapless from 0 in its shard) and the shard in the ``grown`` tree."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("_key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    # Equal rows are one from here on, so copies without end are one row per task.
    rows = rows.groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("_n"))
    name = F.coalesce(F.col("_key").cast("string"), F.lit("null"))
    ranges = min(1 << 16, max(1, -(-df.count() // ROWS_PER_RANGE)))
    digest = F.md5(F.concat_ws(":", name, "size", "text_crc32"))
    rows = rows.select("*", digest.alias("_d"), name.alias("_name"))
    rows = with_shard(with_shard(rows, "_name", tree, "shard"), "_name", grown, "grown_shard")
    rows = rows.withColumn("_r", F.floor(F.conv(F.substring("_d", 1, 4), 16, 10).cast("long") * ranges / 65536).cast("int"))
    base = rows.groupBy("shard", "_r").agg(F.sum("_n").alias("_c"))
    base = base.select("shard", "_r", (F.sum("_c").over(W.partitionBy("shard").orderBy("_r").rowsBetween(W.unboundedPreceding, 0)) - F.col("_c")).alias("_base"))
    inside = F.sum("_n").over(W.partitionBy("shard", "_r").orderBy("_d").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    slots = rows.withColumn("_in", inside).join(base, ["shard", "_r"]).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"))
    return slots.select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_base") + F.col("_in") + F.col("_i")).alias("slot"), "grown_shard"
    )


def _sql_shard(tree: Node, key: str = "name") -> str:
    if tree.shard is not None:
        return str(tree.shard)
    if len(tree.children) == 1:
        return _sql_shard(tree.children[0], key)
    draws = [f"ln((cast(('0x' || substr(md5({key} || ':{n.name}'), 1, 13)) as bigint) + 1) / 4503599627370496.0::double) / {n.weight}::double" for n in tree.children]
    cases = " ".join(f"when {i + 1} then {_sql_shard(n, key)}" for i, n in enumerate(tree.children))
    return f"(case list_position([{', '.join(draws)}], list_max([{', '.join(draws)}])) {cases} end)"


def shards_sql(tree: Node, grown: Node) -> str:
    """The same assignment in SQL for DuckDB, which has no crc32: it is worked out byte
    by byte from the polynomial."""
    step = "case when {c} & 1 = 1 then xor({c} >> 1, 3988292384) else {c} >> 1 end"
    entry = "n"
    for i in range(8):
        entry = f"(select {step.format(c='c')} from (select {entry} as c) t{i})"
    return f"""
with crc_table as (select list(e order by n) as t from (select n, {entry} as e from (select unnest(range(256))::bigint as n))),
texts as (select distinct coalesce(text, '') as body from documents),
crcs as (select body, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: cast('0x' || x as bigint))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as text_crc32 from texts, crc_table),
rows_ as (select doc_id, strlen(body) + 1 as size, text_crc32, coalesce(cast(doc_id as varchar), 'null') as name
  from (select doc_id, coalesce(text, '') as body from documents) join crcs using (body)),
placed as (select *, {_sql_shard(tree)} as shard, {_sql_shard(grown)} as grown_shard, md5(concat_ws(':', name, size, text_crc32)) as d from rows_)
select doc_id, cast(size as bigint) as size, text_crc32, 'key' as law, cast(shard as integer) as shard,
  row_number() over (partition by shard order by d) - 1 as slot, cast(grown_shard as integer) as grown_shard from placed"""
