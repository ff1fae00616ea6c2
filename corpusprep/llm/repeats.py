"""Finds every window of a fixed size that also starts earlier in the corpus.

What op4 (20 words) and op7 (100 bytes) share. A method picks, for every window, a
place in it that depends on the window's content alone: equal windows pick equal
places. Consecutive windows that pick the same place are one *group* row with

* a name of the content around the place, equal for groups that hold equal windows;
* a name of everything its windows cover.

Groups are dealt by the first name. One whose second name is there earlier holds
repeats only. If all groups of a first name have the same second name, the earliest
holds none. Only where groups agree in the first and differ in the second name, as at
the edges of a repeated passage, the windows of the earliest of each kind are named
and compared one by one. So what moves is a row of some 25 bytes per group, and a
row per window at the edges.

A task sends only the earliest of equal groups or windows: copies without end are one
row per task. All dealing is by hashes of content or of (key, sequence number), into
as many parts as ``spark.sql.shuffle.partitions`` says, which bounds a part.

Rows are ordered by (key, sequence number): null keys come first, and rows with equal
keys are numbered by their content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.common import give_back_memory, shuffle_tasks, stored
from corpusprep.llm.hashing import mix

SLICE_BYTES = 1 << 18
#: A longer text is looked at in parts of so many units, with a window's overlap.
LONG = 1 << 19
GROUPS_AT_ONCE = 1 << 18
#: Kinds of one name that a task sends by name at once; of those beyond, the windows
#: are compared, as there are different kinds anyway.
KINDS = 64
#: Texts are sent in compressed packs made of so many bytes of all parts.
PACK_BYTES = 16 << 20
NULL_KEY = -(1 << 63)
#: Rows with equal keys are numbered within so many parts of their content's hash.
NUMBERING = 1024

PART, TEXT, KEY, SEQ = "__part", "__text", "__key", "__seq"


@dataclass(frozen=True)
class Method:
    """``size``: units of a window. ``units(data, bounds)``: codes of the units of texts
    that lie behind each other, and the texts' bounds in units. ``groups(codes,
    bounds)``: first names, and first and last window of each group."""

    size: int
    units: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    groups: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]
    context: Callable[[np.ndarray], Callable[[np.ndarray, np.ndarray], np.ndarray]]
    names: Callable[[np.ndarray], Callable[[np.ndarray, np.ndarray], np.ndarray]]


# --- packed rows ----------------------------------------------------------------

GROUP = [("name", "<u8"), ("cover", "<u8"), ("key", "<i8"), ("seq", "<u4"), ("at", "<u4"), ("n", "<u2")]
ASK = [("key", "<i8"), ("seq", "<u4"), ("at", "<u4"), ("n", "<u2")]
WINDOW = [("name", "<u8"), ("cover", "<u8"), ("key", "<i8"), ("seq", "<u4"), ("at", "<u4")]
SPAN = [("key", "<i8"), ("seq", "<u4"), ("at", "<u4"), ("end", "<u4")]

Rows = dict[str, np.ndarray]


def pack_rows(kind: list, rows: Rows, chosen: np.ndarray) -> bytes:
    """Column by column, so that the shuffle's compression finds what repeats."""
    return b"".join(np.ascontiguousarray(rows[c][chosen].astype(t, copy=False)).tobytes() for c, t in kind)


def unpack_rows(kind: list, blobs: list[bytes]) -> Rows:
    width = sum(np.dtype(t).itemsize for _, t in kind)
    parts: dict[str, list] = {c: [] for c, _ in kind}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for c, t in kind:
            parts[c].append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return {c: np.concatenate(parts[c]) if parts[c] else np.zeros(0, t) for c, t in kind}


def dealt(kind_no: int, kind: list, rows: Rows, part: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """One packed row for each part."""
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1)) if len(part) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        chosen = order[a:b]
        yield int(part[chosen[0]]), kind_no, pack_rows(kind, rows, chosen)


def part_of_key(key: np.ndarray, seq: np.ndarray, parts: int) -> np.ndarray:
    hashes = mix(mix(key.astype(np.int64).view(np.uint64)) + seq.astype(np.uint64))
    return (hashes % np.uint64(parts)).astype(np.int64)


def merged(rows: Rows) -> Rows:
    """Spans of each row of the table, joined where they touch or overlap."""
    if not len(rows["key"]):
        return rows
    order = np.lexsort((rows["at"], rows["seq"], rows["key"]))
    key, seq = rows["key"][order], rows["seq"][order]
    at, end = rows["at"][order].astype(np.int64), rows["end"][order].astype(np.int64)
    text = np.cumsum(np.concatenate([[0], (np.diff(key) != 0) | (np.diff(seq) != 0)]))
    far = int(end.max()) + 2
    reach = np.maximum.accumulate(end + text * far)
    new = np.concatenate([[True], at[1:] + text[1:] * far > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return {"key": key[first], "seq": seq[first], "at": at[first], "end": reach[last] - text[last] * far}


def earliest(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """An order by (name, cover, place), and which of it is the first of its kind."""
    order = np.lexsort((rows["at"], rows["seq"], rows["key"], rows["cover"], rows["name"]))
    name, cover = rows["name"][order], rows["cover"][order]
    return order, np.concatenate([[True], (name[1:] != name[:-1]) | (cover[1:] != cover[:-1])])[: len(order)]


def spans_of(rows: Rows, chosen: np.ndarray, size: int) -> Rows:
    n = rows["n"][chosen].astype(np.int64) if "n" in rows else 1
    at = rows["at"][chosen].astype(np.int64)
    return merged({"key": rows["key"][chosen], "seq": rows["seq"][chosen], "at": at, "end": at + n + size - 1})


# --- texts ----------------------------------------------------------------------


def text_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with their texts' bytes behind each other, and the bounds."""
    sizes = np.asarray(pc.binary_length(batch.column(TEXT)))
    if not len(sizes):
        return
    group = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(sizes)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        part = batch.slice(a, b - a)
        bounds = np.concatenate([[0], np.cumsum(sizes[a:b].astype(np.int64))])
        texts = part.column(TEXT)
        data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
        yield part, data, bounds
    give_back_memory()


def in_pieces(codes: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The codes, their bounds, the text of each piece and where it starts in it; long
    texts come in several pieces that overlap by a window less one."""
    if not len(bounds) or (np.diff(bounds) <= LONG).all():
        yield codes, bounds, np.arange(len(bounds) - 1), np.zeros(len(bounds) - 1, np.int64)
        return
    for text, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        for at in range(0, max(1, b - a - size + 1), LONG):
            piece = codes[a + at : min(b, a + at + LONG + size - 1)]
            yield piece, np.array([0, len(piece)]), np.array([text]), np.array([at])


# --- the three jobs -------------------------------------------------------------

SCHEMA = f"{PART} int, kind int, rows binary"
GROUPS, SPANS, ASKS, WINDOWS = range(4)


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    parts, kinds, blobs = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], names=[PART, "kind", "rows"])


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _joined(parts: list[Rows]) -> Rows:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _send(kind_no: int, kind: list, parts: list[Rows], tasks: int, size: int) -> Iterator[pa.RecordBatch]:
    """The earliest of equal rows, groups dealt by name and windows by both names; the
    others are repeats."""
    rows = _joined(parts)
    order, first = earliest(rows)
    out = list(dealt(SPANS, SPAN, s := spans_of(rows, order[~first], size), part_of_key(s["key"], s["seq"], tasks)))
    kinds = order[first]
    if kind_no == GROUPS:
        name = rows["name"][kinds]
        begin = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        place = np.arange(len(kinds)) - np.repeat(begin, np.diff(np.append(begin, len(kinds))))
        asked = {c: rows[c][kinds[place >= KINDS]] for c, _ in ASK}
        out += dealt(ASKS, ASK, asked, part_of_key(asked["key"], asked["seq"], tasks))
        kinds = kinds[place < KINDS]
        hashes = rows["name"]
    else:
        hashes = mix(rows["name"] + rows["cover"])
    kinds = np.sort(kinds)  # in the order of the texts
    out += dealt(kind_no, kind, {c: v[kinds] for c, v in rows.items()}, (hashes[kinds] % np.uint64(tasks)).astype(np.int64))
    for i in range(0, len(out), 64):
        yield _batch(out[i : i + 64])


def _find_groups(method: Method, tasks: int):
    def run(batches):
        kept, n = [], 0
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                keys = np.asarray(part.column(KEY))
                seqs = np.asarray(part.column(SEQ))
                for codes, edges, text, at in in_pieces(*method.units(data, bounds), method.size):
                    name, lo, hi = method.groups(codes, edges)
                    if not len(name):
                        continue
                    cover = method.context(codes)(lo, hi + method.size)
                    piece = np.searchsorted(edges, lo, "right") - 1
                    rows = {"name": name, "cover": cover, "key": keys[text[piece]], "seq": seqs[text[piece]].astype(np.uint32)}
                    kept.append(rows | {"at": (lo - edges[piece] + at[piece]).astype(np.uint32), "n": (hi - lo + 1).astype(np.uint16)})
                    n += len(name)
                    if n >= GROUPS_AT_ONCE:
                        yield from _send(GROUPS, GROUP, kept, tasks, method.size)
                        kept, n = [], 0
        if kept:
            yield from _send(GROUPS, GROUP, kept, tasks, method.size)

    return run


def _of_kind(table: pa.Table, kind: int) -> list[bytes]:
    return table.filter(pc.equal(table.column("kind"), kind)).column("rows").to_pylist()


def _compare_groups(size: int, tasks: int):
    def run(table: pa.Table) -> pa.Table:
        found = [unpack_rows(SPAN, _of_kind(table, SPANS))]
        rows = unpack_rows(GROUP, _of_kind(table, GROUPS))
        part = table.column(PART)[0].as_py()
        out = [(part, ASKS, blob) for blob in _of_kind(table, ASKS)]
        if len(rows["name"]):
            order, first = earliest(rows)
            found.append(spans_of(rows, order[~first], size))
            kinds = order[first]
            name = rows["name"][kinds]
            alone = np.concatenate([[True], name[1:] != name[:-1]]) & np.concatenate([name[1:] != name[:-1], [True]])
            asked = {c: rows[c][kinds[~alone]] for c, _ in ASK}
            out += dealt(ASKS, ASK, asked, part_of_key(asked["key"], asked["seq"], tasks))
        spans = merged(_joined(found))
        out += dealt(SPANS, SPAN, spans, part_of_key(spans["key"], spans["seq"], tasks))
        return _table(out)

    return run


def _name_windows(method: Method, tasks: int):
    half = method.size // 2

    def run(texts: pa.Table, asks: pa.Table) -> pa.Table:
        rows = unpack_rows(ASK, asks.column("rows").to_pylist())
        if not len(rows["key"]):
            return _table([])
        order = np.lexsort((rows["at"], rows["seq"], rows["key"]))
        rows = {c: v[order] for c, v in rows.items()}
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(rows["key"]) != 0) | (np.diff(rows["seq"]) != 0)]))
        ends = np.append(starts[1:], len(order))
        where = {(int(rows["key"][a]), int(rows["seq"][a])): (a, b) for a, b in zip(starts, ends, strict=True)}
        kept = []
        for batch in unpack_texts(texts):
            for part, data, bounds in text_slices(batch):
                keys, seqs = np.asarray(part.column(KEY)), np.asarray(part.column(SEQ))
                asked = [where.get(p) for p in zip(keys.tolist(), seqs.tolist(), strict=True)]
                if not any(asked):
                    continue
                codes, edges = method.units(data, bounds)
                names = method.names(codes)
                ids = np.concatenate([np.arange(*x) for x in asked if x])
                text = np.concatenate([np.full(x[1] - x[0], i) for i, x in enumerate(asked) if x])
                n = rows["n"][ids].astype(np.int64)
                begin = np.cumsum(n) - n
                inside = np.arange(n.sum()) - np.repeat(begin, n)
                at = np.repeat(rows["at"][ids].astype(np.int64), n) + inside
                text = np.repeat(text, n)
                i = edges[text] + at
                kept.append({"name": names(i, i + half), "cover": names(i + half, i + method.size), "key": keys[text], "seq": seqs[text].astype(np.uint32), "at": at.astype(np.uint32)})
        return pa.Table.from_batches(list(_send(WINDOWS, WINDOW, kept, tasks, method.size)) if kept else [_batch([])])

    return run


def _compare_windows(size: int, tasks: int):
    def run(table: pa.Table) -> pa.Table:
        found = [unpack_rows(SPAN, _of_kind(table, SPANS))]
        rows = unpack_rows(WINDOW, _of_kind(table, WINDOWS))
        if len(rows["name"]):
            order, first = earliest(rows)
            found.append(spans_of(rows, order[~first], size))
        spans = merged(_joined(found))
        return _table(list(dealt(SPANS, SPAN, spans, part_of_key(spans["key"], spans["seq"], tasks))))

    return run


def _pack_texts(tasks: int):
    def pack(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        part = part_of_key(np.asarray(table.column(KEY)), np.asarray(table.column(SEQ)), tasks)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            sink = pa.BufferOutputStream()
            mine = table.take(pa.array(order[a:b])).combine_chunks()
            with pa.ipc.new_stream(sink, mine.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(mine)
            blob = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([part[order[a]]], pa.int32()), blob], names=[PART, "texts"])

    def run(batches):
        kept, size = [], 0
        for batch in batches:
            sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(TEXT))).astype(np.int64))
            at = 0
            while at < batch.num_rows:  # no more than a pack's bytes of a batch at once
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PACK_BYTES)))
                kept.append(batch.slice(at, upto - at))
                size += int(sizes[min(upto, len(sizes)) - 1] - (sizes[at - 1] if at else 0))
                at = upto
                if size >= PACK_BYTES:
                    yield from pack(kept)
                    kept, size = [], 0
        if kept:
            yield from pack(kept)

    return run


def texts_by_part(texts: DataFrame, tasks: int) -> DataFrame:
    """Packs of texts, dealt like packed rows that carry their keys."""
    return texts.mapInArrow(_pack_texts(tasks), f"{PART} int, texts binary")


def unpack_texts(packs: pa.Table) -> Iterator[pa.RecordBatch]:
    for blob in packs.column("texts"):
        with pa.ipc.open_stream(blob.as_buffer()) as reader:
            yield from reader


def numbered(df: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """The columns KEY, SEQ, TEXT (bytes, empty for null) and ``keep``."""
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias(KEY), F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT), *keep)
    keys = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias(KEY))
    if keys.groupBy(KEY).count().filter("count > 1").isEmpty():
        return rows.withColumn(SEQ, F.lit(0))
    rows = rows.withColumn("__h", F.pmod(F.xxhash64(TEXT), F.lit(NUMBERING)))
    place = F.row_number().over(W.partitionBy(KEY, "__h").orderBy(F.xxhash64(TEXT, F.lit(1)), TEXT)) - 1
    # Long: a third of all rows may have one key.
    return rows.withColumn(SEQ, place.cast("long") * NUMBERING + F.col("__h")).drop("__h")


def repeated_spans(texts: DataFrame, method: Method) -> DataFrame:
    """Packed spans of units that repeated windows cover, dealt by key. ``texts`` is
    what ``numbered`` returns."""
    spark, tasks = texts.sparkSession, shuffle_tasks(texts.sparkSession)
    rows = texts.select(KEY, SEQ, TEXT)
    groups = rows.mapInArrow(_find_groups(method, tasks), SCHEMA)
    compared = stored(groups.groupBy(PART).applyInArrow(_compare_groups(method.size, tasks), SCHEMA), "repeat-groups")
    asks = compared.filter(F.col("kind") == ASKS)
    windows = texts_by_part(rows, tasks).groupBy(PART).cogroup(asks.groupBy(PART)).applyInArrow(_name_windows(method, tasks), SCHEMA)
    more = windows.groupBy(PART).applyInArrow(_compare_windows(method.size, tasks), SCHEMA)
    return compared.filter(F.col("kind") == SPANS).unionAll(more)


def apply_spans(texts: DataFrame, spans: DataFrame, cut: Callable[[bytes, np.ndarray], tuple], schema: str, keep: list[str]) -> DataFrame:
    """``cut(text, spans)`` for every text, behind the columns ``keep``."""
    tasks = shuffle_tasks(texts.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    types = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    empty = np.zeros((0, 2), np.int64)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(texts.sparkSession.createDataFrame([], schema).schema)

    def run(packs: pa.Table, blobs: pa.Table) -> pa.Table:
        rows = merged(unpack_rows(SPAN, blobs.column("rows").to_pylist()))
        pairs = np.stack([rows["at"].astype(np.int64), rows["end"].astype(np.int64)], 1)
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(rows["key"]) != 0) | (np.diff(rows["seq"]) != 0)])) if len(pairs) else np.zeros(0, int)
        ends = np.append(starts[1:], len(pairs))
        where = {(int(rows["key"][a]), int(rows["seq"][a])): (a, b) for a, b in zip(starts, ends, strict=False)}
        made = []
        for batch in unpack_texts(packs):
            out = []
            for text, key, seq in zip(batch.column(TEXT), batch.column(KEY).to_pylist(), batch.column(SEQ).to_pylist(), strict=True):
                a, b = where.get((key, seq), (0, 0))
                out.append(cut(text.as_py(), pairs[a:b] if b else empty))
            columns = [pa.array([o[i] for o in out], f.type) for i, f in enumerate(arrow)]
            made.append(pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *arrow.names]))
        if not made:
            return pa.table({c: [] for c in [*keep, *arrow.names]})
        return pa.Table.from_batches(made)

    packs = texts_by_part(texts.select(KEY, SEQ, TEXT, *keep), tasks)
    return packs.groupBy(PART).cogroup(spans.groupBy(PART)).applyInArrow(run, f"{types}, {schema}" if keep else schema)
