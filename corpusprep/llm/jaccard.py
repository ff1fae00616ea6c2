"""Documents linked by the Jaccard similarity of their word shingles: a size-aware
join, light for small sets and heavy for large ones.

Documents with equal sets are one node. Two nodes link when
``100 * intersection >= THRESHOLD * union``.

Light: of a small set all subsets of fixed sizes are enumerated, those that a partner
may have in common with it (the set less at most a tenth of its elements). Two sets
with an equal subset are linked if it is large enough against their sizes, with no
further look at them; in the list of a subset, whoever links with anyone links with
the smallest set. That set may be in another task, so a task sends its smallest one and
all that do not link with that.

Heavy: larger sets are scanned by inverted lists. A list per single shingle would be
as long as a passage is common, so lists stand for blocks: a set's hashes are cut into
``limit + 1 + SPARE`` ranges, where ``limit`` is how many elements two linked sets of
that size class may not share. At least ``1 + SPARE`` ranges are then equal, and a set
is listed under what it has in each range. (Sets with more than ``SPARE`` empty ranges
are listed under those, too.) Sets on one list are brought together, as connected
groups, and their similarity is counted element by element.

The size up to which sets are light is chosen by cost, from the counts of the sizes.

Groups of up to ``GROUP_BYTES`` of sets are one task's work: a set at a time is
compared with all, the most typical first, until only one component is left or all
outside the largest have been compared; so every pair that may link two components is
counted. Larger groups are cut into parts, and rounds send ``PIVOTS`` sets of a group
to all its parts, until the same holds.

What moves: a key and a number per list entry, the sets that share a list with
another, and edges. Of a list, tasks send one entry and those that it does not link with
(whoever else shares it inside the task is an edge), so a block list that a third of all
sets is on stays as short as there are tasks. Names are 64-bit hashes.

Defined results: null or wordless text has an empty set and links with nothing; equal
texts and equal sets link; a null key counts as no key: the component's is the
smallest there is, or null; repeated rows stay; only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import shuffle_tasks, stored
from corpusprep.llm.graph import components
from corpusprep.llm.hashing import Names, mix, word_codes, words_in
from corpusprep.llm.repeats import TEXT, pack_rows, text_slices, unpack_rows

SHINGLE = 3
THRESHOLD = 90
SPARE = 2
#: Sizes that the light way may reach, before the next deletion per set gets too dear.
BOUNDARIES = (9, 19, 29)
ENTRIES_AT_ONCE = 1 << 20
GROUP_BYTES = 32 << 20
PIVOTS = 16
#: Bits of the filter that spares the sets of documents without candidates the way.
FILTER_BITS = 1 << 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# --- sets -----------------------------------------------------------------------


def sets_of(data: np.ndarray, bounds: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of texts that lie behind each other: hashes, sorted and distinct
    within each text, and the texts' bounds among them."""
    data = _LOWER[data]
    starts, ends, edges = words_in(data, bounds)
    names = Names(word_codes(data, starts, ends))
    words = np.diff(edges)
    many = np.maximum(words - shingle + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(words)), many)
    at = edges[:-1][text] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    hashes = names(at, np.minimum(at + shingle, edges[1:][text]))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])[: len(hashes)]
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(words) + 1))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of stretches that may be empty."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def nodes_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A set's name: equal for equal sets."""
    return mix(sums(mix(hashes), bounds) + np.diff(bounds).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _members(shingle: int):
    def run(batches):
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                hashes, edges = sets_of(data, bounds, shingle)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(nodes_of(hashes, edges)), pa.array(np.diff(edges))], names=["key", "node", "n"])

    return run


# --- what sets are listed under -------------------------------------------------


def deletions(n: int, threshold: int) -> int:
    """How many elements of a set of n a linked set may lack."""
    return n - -(-threshold * n // 100)


def choose_boundary(sizes: dict[int, int], threshold: int) -> int:
    """The boundary with the fewest list entries, where an entry of a large set counts
    three times for the comparison that it leads to."""

    def cost(x: int) -> float:
        light = sum(c * subsets(n, threshold) for n, c in sizes.items() if 0 < n <= x * 100 // threshold)
        heavy = sum(c * (2 + SPARE + 2 * (n * (100 - threshold) // threshold)) for n, c in sizes.items() if n > x)
        return light + 3 * heavy

    return min(BOUNDARIES, key=cost)


def subsets(n: int, threshold: int) -> int:
    return sum(comb(n, d) for d in range(deletions(n, threshold) + 1))


def size_classes(boundary: int, largest: int, threshold: int) -> np.ndarray:
    """First sizes of the classes of large sets. A set's partners are in its class or in
    one next to it."""
    first = [boundary + 1]
    while first[-1] <= largest:
        first.append(first[-1] * 100 // threshold + 1)
    return np.array(first)


def light_entries(hashes: np.ndarray, bounds: np.ndarray, threshold: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(set, subsets' names, elements left out) for sets of up to ``most`` elements."""
    mixed = mix(hashes)
    for i in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) <= most)):
        own = mixed[bounds[i] : bounds[i + 1]]
        total, n = own.sum(dtype=np.uint64), len(own)
        names, out = [np.array([total])], [np.zeros(1, np.int64)]
        for d in range(1, deletions(n, threshold) + 1):
            gone = np.array(list(combinations(range(n), d)))
            names.append(total - own[gone].sum(1, dtype=np.uint64))
            out.append(np.full(len(gone), d))
        left = np.concatenate(out)
        yield i, mix(np.concatenate(names) + (n - left).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), left


def heavy_entries(hashes: np.ndarray, bounds: np.ndarray, classes: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(set, block name) pairs of sets above the boundary."""
    n = np.diff(bounds)
    large = np.flatnonzero(n >= classes[0])
    owners, names = [], []
    if not len(large):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own_class = np.searchsorted(classes, n[large], "right") - 1
    size = n[large]
    owner = np.repeat(np.arange(len(large)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds[large], size)
    own = hashes[at]
    mixed, high = mix(own), own >> np.uint64(32)
    for back in (0, 1):  # as the smaller of a pair, and as the larger of a pair
        k = own_class - back
        used = k >= 0
        last = classes[np.maximum(k, 0) + 1] - 1
        parts = np.where(used, last * (100 - threshold) // threshold + 1 + SPARE, 1)
        block = ((high * parts[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        begin = np.cumsum(parts) - parts
        slot = begin[owner] + block
        # Hashes rise within a set, so slots rise throughout.
        edges = np.searchsorted(slot, np.arange(parts.sum() + 1))
        filled = np.diff(edges) > 0
        which = np.repeat(np.arange(len(large)), parts)
        inside = np.arange(parts.sum()) - begin[which]
        tag = (k[which] + 2).astype(np.uint64) * np.uint64(1 << 32) + inside.astype(np.uint64)
        name = mix(sums(mixed, edges) + mix(tag))
        empty = np.bincount(which[~filled], minlength=len(large))
        listed = used[which] & (filled | (empty[which] > SPARE))
        owners.append(large[which[listed]])
        names.append(name[listed])
    return np.concatenate(owners), np.concatenate(names)


# --- lists ----------------------------------------------------------------------

LINK, SAME_LIST = 0, 1
EDGE_SCHEMA = "a long, b long, kind int"
ENTRY = [("name", "<u8"), ("node", "<i8"), ("n", "<u4"), ("out", "<u1")]
EDGE = [("a", "<i8"), ("b", "<i8"), ("kind", "<u1")]


def _links(name: np.ndarray, node: np.ndarray, n: np.ndarray, out: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries of every list that stay open, its first and those not linked with it,
    and edges from the first to the others. ``out`` is how many elements a subset lacks,
    255 on block lists.

    Whoever is left out links with the first. If it links with anyone elsewhere, so does
    the first with the first of all, as neither lacks more."""
    order = np.lexsort((node, out, name))
    name, node, n, out = name[order], node[order], n[order], out[order]
    first = np.concatenate([[True], name[1:] != name[:-1]])[: len(name)]
    head = np.maximum.accumulate(np.where(first, np.arange(len(name)), 0)) if len(name) else first
    common = n - out
    union = common + out + out[head]
    linked = 100 * common >= threshold * union
    other = ~first & (node != node[head])
    edge = other & ((out == 255) | linked)
    kind = np.where(out[edge] == 255, SAME_LIST, LINK)
    pairs = np.unique(np.stack([node[head[edge]], node[edge], kind.astype(np.int64)], 1), axis=0) if edge.any() else np.zeros((0, 3), np.int64)
    return order[first | (other & ~edge)], pairs[:, 0], pairs[:, 1], pairs[:, 2]


def _packed(kind: list, rows: dict, part: np.ndarray, is_edge: bool) -> Iterator[pa.RecordBatch]:
    """One packed row for each part."""
    order = np.argsort(part, kind="stable")
    ends = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
    for x, y in zip(ends[:-1], ends[1:], strict=True):
        blob = pack_rows(kind, rows, order[x:y])
        yield pa.RecordBatch.from_arrays([pa.array([part[order[x]]], pa.int32()), pa.array([is_edge]), pa.array([blob], pa.binary())], names=["part", "is_edge", "rows"])


def _entries(shingle: int, threshold: int, boundary: int, classes: np.ndarray, tasks: int):
    def send(kept: list[dict]) -> Iterator[pa.RecordBatch]:
        rows = {c: np.concatenate([k[c] for k in kept]) for c, _ in ENTRY}
        still_open, a, b, kind = _links(rows["name"], rows["node"], rows["n"].astype(np.int64), rows["out"].astype(np.int64), threshold)
        if len(a):
            yield from _packed(EDGE, {"a": a, "b": b, "kind": kind}, (a.view(np.uint64) % np.uint64(tasks)).astype(np.int64), True)
        still_open = np.sort(still_open)  # in the order of the texts
        kept_rows = {c: v[still_open] for c, v in rows.items()}
        yield from _packed(ENTRY, kept_rows, (kept_rows["name"] % np.uint64(tasks)).astype(np.int64), False)

    def run(batches):
        kept, size, met = [], 0, set()
        for batch in batches:
            for _, data, bounds in text_slices(batch):
                hashes, edges = sets_of(data, bounds, shingle)
                nodes = nodes_of(hashes, edges)
                # Equal sets have equal entries: the first is enough.
                _, once = np.unique(nodes, return_index=True)
                new = np.zeros(len(nodes), bool)
                new[[i for i in once if int(nodes[i]) not in met]] = True
                met.update(nodes[new].tolist())
                if len(met) > ENTRIES_AT_ONCE:
                    met.clear()
                n = np.diff(edges)
                owner, name = heavy_entries(hashes, edges, classes, threshold)
                chosen = new[owner]
                owner, name = owner[chosen], name[chosen]
                order = np.argsort(owner, kind="stable")
                owner, name = owner[order], name[order]
                parts = [(name, owner, np.full(len(owner), 255))]
                parts += [(h, np.full(len(h), i), left) for i, h, left in light_entries(hashes, edges, threshold, boundary * 100 // threshold) if new[i]]
                for names, own, out in parts:
                    kept.append({"name": names, "node": nodes[own], "n": n[own], "out": out})
                    size += len(names)
                if size >= ENTRIES_AT_ONCE:
                    yield from send(kept)
                    kept, size = [], 0
        if kept:
            yield from send(kept)

    return run


def _list_edges(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        is_edge = table.column("is_edge")
        rows = unpack_rows(ENTRY, table.filter(pc.invert(is_edge)).column("rows").to_pylist())
        _, a, b, kind = _links(rows["name"], rows["node"], rows["n"].astype(np.int64), rows["out"].astype(np.int64), threshold)
        local = unpack_rows(EDGE, table.filter(is_edge).column("rows").to_pylist())
        a, b = np.concatenate([a, local["a"]]), np.concatenate([b, local["b"]])
        return pa.table([pa.array(a), pa.array(b), pa.array(np.concatenate([kind, local["kind"]]).astype(np.int32))], names=["a", "b", "kind"])

    return run


# --- comparing the sets of a group ----------------------------------------------


class Forest:
    """Components of numbers 0 to n - 1."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, one: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[one]))
        self.root[np.isin(self.root, roots)] = roots[0]


def compare_group(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """The component of every set: all pairs that could join two components are counted.

    The sets are taken one at a time, the most typical first. A pair of components has
    a member outside the largest, so once all of those have been taken, no pair is
    left."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    elements, ids = np.unique(flat, return_inverse=True)
    typical = np.add.reduceat(np.bincount(ids)[ids], bounds[:-1]) / sizes
    order = np.argsort(-typical, kind="stable")
    forest, marked = Forest(n), np.zeros(len(elements), np.int64)
    taken = np.zeros(n, bool)
    while True:
        counts = np.bincount(forest.root, minlength=n)
        largest = int(counts.argmax())
        if counts[largest] == n:
            break
        # The most typical set of all first, then sets outside the largest component.
        todo = order[~taken[order] & ((forest.root[order] != largest) | ~taken.any())]
        if not len(todo):
            break
        one = int(todo[0])
        taken[one] = True
        own = ids[bounds[one] : bounds[one + 1]]
        near = np.flatnonzero((100 * np.minimum(sizes, sizes[one]) >= threshold * np.maximum(sizes, sizes[one])) & (forest.root != forest.root[one]))
        if len(near):
            marked[own] = 1
            common = _common(marked, ids, bounds, near)
            marked[own] = 0
            linked = near[100 * common >= threshold * (sizes[near] + sizes[one] - common)]
            if len(linked):
                forest.join(one, linked)
    return forest.root


def _common(marked: np.ndarray, ids: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Marked elements of the sets ``which``."""
    if len(which) * 4 > len(bounds):
        return np.add.reduceat(marked[ids], bounds[:-1])[which]
    size = bounds[which + 1] - bounds[which]
    begin = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(begin - bounds[which], size)
    return np.add.reduceat(marked[ids[at]], begin)


def _needed_sets(shingle: int, bits: np.ndarray):
    def run(batches):
        met: set[int] = set()
        for batch in batches:
            for _, data, bounds in text_slices(batch):
                hashes, edges = sets_of(data, bounds, shingle)
                nodes = nodes_of(hashes, edges)
                at = nodes.view(np.uint64) % np.uint64(FILTER_BITS)
                chosen = [i for i in np.flatnonzero(bits[at.astype(np.int64)]) if int(nodes[i]) not in met and not met.add(int(nodes[i]))]
                if len(met) > ENTRIES_AT_ONCE:
                    met.clear()
                if chosen:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[chosen]), pa.array([hashes[edges[i] : edges[i + 1]].tobytes() for i in chosen], pa.binary())], names=["node", "hashes"]
                    )

    return run


def _compare(threshold: int):
    def run(table: pa.Table) -> pa.Table:
        """Groups of one task, one after the other."""
        groups, nodes = table.column("group").to_numpy(), table.column("node").to_numpy()
        order = np.lexsort((nodes, groups))
        new = np.concatenate([[True], (np.diff(groups[order]) != 0) | (np.diff(nodes[order]) != 0)])[: len(order)]
        order = order[new]  # copies of one set may come from several tasks
        edges = np.flatnonzero(np.diff(groups[order], prepend=groups[order[0]] - 1 if len(order) else 0)) if len(order) else np.zeros(0, int)
        blobs, a, b = table.column("hashes").to_pylist(), [], []
        for x, y in zip(edges, [*edges[1:], len(order)], strict=False):
            mine = order[x:y]
            root = compare_group([np.frombuffer(blobs[i], np.uint64) for i in mine], threshold)
            a.append(nodes[mine[root]])
            b.append(nodes[mine])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        return pa.table([pa.array(a[a != b]), pa.array(b[a != b]), pa.array(np.full(int((a != b).sum()), LINK, np.int32))], names=["a", "b", "kind"])

    return run


def _compare_with_pivots(threshold: int):
    def run(pivots: pa.Table, others: pa.Table) -> pa.Table:
        sets = [np.frombuffer(v, np.uint64) for v in others.column("hashes").to_pylist()]
        nodes = others.column("node").to_numpy()
        a, b = [], []
        for node, blob in zip(pivots.column("pivot").to_pylist(), pivots.column("pivot_hashes").to_pylist(), strict=True) if sets else ():
            own = np.frombuffer(blob, np.uint64)
            for other, s in zip(nodes, sets, strict=True):
                if 100 * min(len(own), len(s)) >= threshold * max(len(own), len(s)):
                    common = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * common >= threshold * (len(own) + len(s) - common):
                        a.append(node)
                        b.append(int(other))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([LINK] * len(a), pa.int32())], names=["a", "b", "kind"])

    return run


def _compare_large(sets: DataFrame, threshold: int, tasks: int, group_bytes: int, pivots: int) -> DataFrame | None:
    """Links inside groups too large for one task, in rounds. ``sets`` has group, node,
    bytes of the group and hashes, each node once."""
    spark = sets.sparkSession
    links = None
    taken = spark.createDataFrame([], "node long")
    state = sets.select("group", "node").withColumn("root", F.col("node"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("bytes") / group_bytes)).cast("int")
    others = stored(sets.select("group", "node", "hashes", chunks.alias("chunks"), F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk")), "large-groups")
    as_pivots = others.select(F.col("group").alias("g"), F.col("node").alias("pivot"), F.col("hashes").alias("pivot_hashes"), F.col("chunks").alias("parts"))
    while True:
        # Sets outside the largest component of their group that have not been taken.
        sizes = state.groupBy("group", "root").count()
        largest = sizes.groupBy("group").agg(F.max_by("root", F.struct("count", "root")).alias("_largest"), F.max("count").alias("_most"), F.sum("count").alias("_all"))
        rest = state.join(largest, "group").filter("_most < _all").join(taken, "node", "left_anti")
        todo = rest.filter((F.col("root") != F.col("_largest")) | (F.col("_most") == 1))
        place = F.row_number().over(_by_group())
        chosen = stored(todo.withColumn("_p", place).filter(F.col("_p") <= pivots).select("group", "node"), "pivots")
        if chosen.isEmpty():
            return links
        taken = stored(taken.unionAll(chosen.select("node")), "taken")
        sent = as_pivots.join(chosen, (F.col("g") == F.col("group")) & (F.col("pivot") == F.col("node"))).select(
            "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pivot", "pivot_hashes"
        )
        found = stored(sent.groupBy("g", "part").cogroup(others.groupBy("group", "chunk")).applyInArrow(_compare_with_pivots(threshold), EDGE_SCHEMA), "large-links")
        links = found if links is None else links.unionAll(found)
        roots = components(links)
        state = state.drop("root").join(roots, "node", "left").select("group", "node", F.coalesce("root", "node").alias("root"))
        state = stored(state, "large-state")


def _by_group() -> WindowSpec:
    return W.partitionBy("group").orderBy(F.xxhash64("node"), "node")


# --- the join -------------------------------------------------------------------


def jaccard_classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, group_bytes: int = GROUP_BYTES, pivots: int = PIVOTS
) -> DataFrame:
    """Per row of ``df``: key, n_shingles, component_id (the smallest key of all that
    links reach), class_id (one number per class) and set_id (one per set); both are 0
    for empty sets."""
    spark, tasks = df.sparkSession, shuffle_tasks(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))
    members = stored(rows.mapInArrow(_members(shingle), f"key {kind}, node long, n long"), "sets")
    sizes = {r[0]: r[1] for r in members.groupBy(F.least("n", F.lit(64)).alias("n")).count().collect()}
    largest = members.agg(F.max("n")).first()[0] or 0
    boundary = choose_boundary(sizes, threshold)
    classes = size_classes(boundary, largest, threshold)

    texts = rows.select(TEXT)
    listed = texts.mapInArrow(_entries(shingle, threshold, boundary, classes, tasks), "part int, is_edge boolean, rows binary")
    edges = stored(listed.groupBy("part").applyInArrow(_list_edges(threshold), EDGE_SCHEMA).distinct(), "list-edges")

    # Sets that share a list are compared within their group.
    groups = components(edges.filter(F.col("kind") == SAME_LIST))
    links = edges.filter(F.col("kind") == LINK).select("a", "b")
    compared = _compare_groups(texts, members, groups, shingle, threshold, tasks, group_bytes, pivots)
    roots = components(links.unionAll(compared.select("a", "b")))

    smallest = members.filter("n > 0").groupBy("node").agg(F.min("key").alias("key"))
    smallest = smallest.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "key")
    whole = smallest.groupBy("root").agg(F.min("key").alias("component_id"))
    found = smallest.select("node", "root").join(whole, "root").select("node", "component_id", F.col("root").alias("class_id"))
    columns = [F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", "class_id", F.col("node").alias("set_id")]
    full = members.filter("n > 0").join(found, "node").select(*columns)
    none = F.lit(0).cast("long")
    empty = members.filter("n = 0").withColumns({"component_id": F.col("key"), "class_id": none, "node": none}).select(*columns)
    return full.unionAll(empty)


def _compare_groups(texts: DataFrame, members: DataFrame, groups: DataFrame, shingle: int, threshold: int, tasks: int, group_bytes: int, pivots: int) -> DataFrame:
    sizes = groups.join(members.groupBy("node").agg(F.first("n").alias("n")), "node")
    whole = sizes.groupBy("root").agg((F.sum("n") * 8).alias("bytes"))
    wanted = stored(groups.join(whole, "root").select("node", F.col("root").alias("group"), "bytes"), "groups")
    # A bit per node's hash, of fixed size: it only spares sets that no group holds.
    bit = F.pmod("node", F.lit(FILTER_BITS))
    words = wanted.select((bit / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("m"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for w, m in words.groupBy("w").agg(F.bit_or("m")).collect():
        bits[w] = m
    bits = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)
    sets = texts.mapInArrow(_needed_sets(shingle, bits), "node long, hashes binary").join(wanted, "node")
    small = sets.filter(F.col("bytes") <= group_bytes).select(F.pmod(F.xxhash64("group"), F.lit(tasks)).alias("part"), "group", "node", "hashes")
    found = small.groupBy("part").applyInArrow(_compare(threshold), EDGE_SCHEMA)
    if wanted.filter(F.col("bytes") > group_bytes).isEmpty():
        return found
    large = sets.filter(F.col("bytes") > group_bytes).groupBy("group", "node", "bytes").agg(F.first("hashes").alias("hashes"))
    more = _compare_large(large, threshold, tasks, group_bytes, pivots)
    return found if more is None else found.unionAll(more)


def classes_sql(table: str = "documents", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> str:
    """The same classes in SQL for DuckDB, by counting what every pair has in common."""
    return f"""
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from {table}),
e as (select distinct doc_id, array_to_string(w[i:i + {shingle - 1}], ' ') as s
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - {shingle - 1}, least(len(w), 1)))) as i from t)),
n as (select doc_id, count(*) as n from e group by doc_id),
c as (select x.doc_id as a, y.doc_id as b, count(*) as c from e x join e y using (s) where x.doc_id <> y.doc_id group by all),
l as (select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= {threshold} * (x.n + y.n - c)),
r as (select doc_id as a, doc_id as b from n union select r.a, l.b from r join l on r.b = l.a),
m as (select a as doc_id, min(b) as component_id from r group by a)
select t.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m.component_id, t.doc_id) as component_id from t left join n using (doc_id) left join m using (doc_id)"""


def _with_sets(shingle: int):
    def run(batches):
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                hashes, edges = sets_of(data, bounds, shingle)
                part = part.drop_columns([TEXT])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nodes_of(hashes, edges)), pa.array(np.diff(edges))], names=[*part.schema.names, "__node", "__n"])

    return run


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``df`` with one row of each class, that with the smallest key
    (which is null only if all are); rows with empty sets all stay. Columns as they were."""
    classes = jaccard_classes(df, key, text, shingle, threshold).filter("n_shingles > 0")
    # Of the rows whose key names the class, those with one set; they are one row, or
    # rows with one key and one set.
    named = classes.filter(F.col(key).eqNullSafe(F.col("component_id"))).groupBy("class_id", "component_id", "set_id").agg(F.count("*").alias("n"))
    first = named.groupBy("class_id", F.col("component_id").alias("__key")).agg(F.min_by(F.struct("set_id", "n"), "set_id").alias("__f"))
    first = stored(first.select("__key", F.col("__f.set_id").alias("__first"), F.col("__f.n").alias("__rows")), "kept")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = df.select("*", F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT)).mapInArrow(_with_sets(shingle), f"{kinds}, __node long, __n long")
    kept = rows.join(first, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__node") == F.col("__first")), "left").filter("__n = 0 or __first is not null")
    if not first.filter("__rows > 1").isEmpty():  # keys that repeat: one of their rows
        again = kept.filter("__rows > 1").dropDuplicates([key, "__node"])
        kept = kept.filter("__n = 0 or __rows = 1").unionAll(again)
    return kept.select(*df.columns)
