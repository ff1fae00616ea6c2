"""Alignment of two tokenizers over the same texts, by merge-path partitioning.

A task tokenises its texts with A and B and lays the tokens' byte ends one behind the
other: two sorted lists. Merging them says where both end. Diagonals at equal steps of
the merge, each placed by a binary search, cut it into pieces of equal work that do not
depend on each other, whatever the lengths of the texts; an end that both lists have is
not cut apart. Pieces are written as token ids and are what the next jobs work on:

* links (an A and a B token that end together) are counted over all pieces;
* each piece emits the groups between common ends, per document, and for documents that
  go beyond it the tokens before its first and behind its last common end;
* such boundary parts are brought together by document, in the order of the pieces, and
  stitched into groups. Only they are shuffled.

Of two tokens that end together one is a suffix of the other. So links can be no more
than the tokens' suffixes, a number that follows from the two vocabularies alone, and
counts for all of them are one array, sent to the tasks as a broadcast.

Texts of characters that all Unicode tables sort alike go through the list of ranks of
A's vocabulary, if given, as in ``packing``.

Defined results: null and empty texts, and those whose tokens' bytes do not give the
text back (behind a space), have no tokens: zeros and an empty digest. Equal rows count
as often as they are there; a null key is carried through; an empty table gives no
rows; columns other than the two named are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import give_back_memory, shuffle_tasks, stored
from corpusprep.llm.packing import encoder, slices

#: Steps of the merge (tokens of A and B) in a piece.
WORK = 1 << 16
#: Texts are tokenised in slices of about so many bytes.
SLICE_BYTES = 1 << 20
#: Counts that may be broadcast (8 bytes each).
MOST_LINKS = 1 << 24


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one visible character: the printable
    ones of Latin-1 as themselves, the others, in order, from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    byte = _byte_characters()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in byte for c in token):
            out[i] = bytes(byte[c] for c in token)
        else:
            out[i] = token.encode()
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a sentencepiece model."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]


@dataclass(frozen=True)
class Vocabularies:
    """The bytes of both vocabularies' tokens, and a place for every link they allow."""

    a: list[bytes]
    b: list[bytes]

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in tokens], np.int64) for tokens in (self.a, self.b))

    @cached_property
    def _copies(self) -> tuple[list[np.ndarray], list[int]]:
        """The number of each id among those with the same bytes."""
        numbers, most = [], []
        for tokens in (self.a, self.b):
            seen: dict[bytes, int] = {}
            number = np.zeros(len(tokens), np.int64)
            for i, t in enumerate(tokens):
                number[i] = seen[t] = seen.get(t, -1) + 1
            numbers.append(number)
            most.append(int(number.max(initial=0)) + 1)
        return numbers, most

    @cached_property
    def _starts(self) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(np.concatenate([n + 1 for n in self.lengths]))
        starts = np.concatenate([[0], ends])
        return starts[: len(self.a)], starts[len(self.a) : -1]

    @cached_property
    def links(self) -> int:
        """Links that the vocabularies allow, at most."""
        _, most = self._copies
        return (sum(int((n + 1).sum()) for n in self.lengths)) * most[0] * most[1]

    def link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of pairs of ids one of which is a suffix of the other: the longer
        token and the length of the shorter one say which bytes both have."""
        (copy_a, copy_b), most = self._copies
        of_a, of_b = self._starts
        size_a, size_b = self.lengths[0][a], self.lengths[1][b]
        slot = np.where(size_a >= size_b, of_a[a] + size_b, of_b[b] + size_a)
        return (slot * most[0] + copy_a[a]) * most[1] + copy_b[b]

    @property
    def types(self) -> tuple[np.dtype, np.dtype]:
        return tuple(np.dtype("<u2" if len(t) <= 1 << 16 else "<u4") for t in (self.a, self.b))


def cut_merge(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where diagonals at every ``work`` steps cut the merge of two ascending lists: how
    many of each lie before. Of equal values the one in ``a`` comes first, and they stay
    on one side. Binary searches of all diagonals run side by side."""
    steps = np.arange(work, len(a) + len(b), work)
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        before = np.zeros(len(steps), bool)
        before[open_] = a[middle[open_]] <= b[steps[open_] - middle[open_] - 1]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    i, j = low, steps - low
    if len(steps):
        apart = (i > 0) & (j < len(b))
        apart[apart] = a[i[apart] - 1] == b[j[apart]]
        j = j + apart
    return np.concatenate([[0], i, [len(a)]]), np.concatenate([[0], j, [len(b)]])


PIECE = "piece int, base long, a_from long, b_from long, a binary, b binary, rows array<long>, keys array<{kind}>, ends array<long>"


def _tokenise(a_file: str, a_ranks: str | None, b_file: str, vocabularies, work: int, slice_bytes: int):
    def run(batches):
        from sentencepiece import SentencePieceProcessor

        voc: Vocabularies = vocabularies.value
        encode_a = encoder(a_file, a_ranks, specials_are_text=True)
        model = SentencePieceProcessor(model_file=b_file)
        type_a, type_b = voc.types
        size_a, size_b = voc.lengths
        none = np.zeros(0, np.int64)
        for batch in batches:
            for lo, hi in slices(batch["text"], slice_bytes):
                part = batch.slice(lo, hi - lo)
                texts = part["text"].to_pylist()
                ids_a, ids_b, ends = [], [], np.zeros(len(texts), np.int64)
                made_a, made_b = encode_a([" " + t for t in texts]), model.encode(texts, num_threads=1)
                for k, text in enumerate(texts):
                    body = (" " + text).encode()
                    a, b = np.array(made_a[k], np.int64), np.array(made_b[k], np.int64)
                    # Byte-level tokens are stretches of the text: the length says whether all is there.
                    if text and size_a[a].sum() == len(body) == size_b[b].sum() and b"".join([voc.b[i] for i in made_b[k]]) == body:
                        ends[k] = len(body)
                        ids_a.append(a)
                        ids_b.append(b)
                made_a = made_b = None
                ends = np.cumsum(ends)
                a, b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
                a_ends, b_ends = np.cumsum(size_a[a]), np.cumsum(size_b[b])
                at_a, at_b = cut_merge(a_ends, b_ends, work)
                pieces = len(at_a) - 1
                before_a, before_b = np.concatenate([[0], a_ends]), np.concatenate([[0], b_ends])
                # The first document of a piece is the one that its first token is in.
                first = np.searchsorted(ends, np.minimum(before_a[at_a[:-1]], before_b[at_b[:-1]]), "right")
                last = np.searchsorted(ends, np.maximum(before_a[at_a[1:]], before_b[at_b[1:]]), "left")
                first[0], last[-1] = 0, len(ends) - 1
                last[:-1] = np.maximum(last[:-1], first[1:] - 1)
                lists = [np.arange(f, t + 1) for f, t in zip(first, last, strict=True)]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32))
                listed = pa.array(np.concatenate(lists))
                starts = np.concatenate([[0], ends])
                columns = [
                    pa.array(np.arange(pieces, dtype=np.int32)),
                    pa.array(starts[first]),
                    pa.array(before_a[at_a[:-1]]),
                    pa.array(before_b[at_b[:-1]]),
                    pa.array([a[x:y].astype(type_a).tobytes() for x, y in zip(at_a[:-1], at_a[1:], strict=True)], pa.binary()),
                    pa.array([b[x:y].astype(type_b).tobytes() for x, y in zip(at_b[:-1], at_b[1:], strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(offsets, part["row"].take(listed)),
                    pa.ListArray.from_arrays(offsets, part["key"].take(listed)),
                    pa.ListArray.from_arrays(offsets, pa.array(ends).take(listed)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "base", "a_from", "b_from", "a", "b", "rows", "keys", "ends"])
        give_back_memory()

    return run


class Piece:
    """A piece's tokens, their ends, and where both end."""

    def __init__(self, voc: Vocabularies, row: dict):
        type_a, type_b = voc.types
        size_a, size_b = voc.lengths
        self.a, self.b = np.frombuffer(row["a"], type_a).astype(np.int64), np.frombuffer(row["b"], type_b).astype(np.int64)
        self.a_ends = row["a_from"] + np.cumsum(size_a[self.a])
        self.b_ends = row["b_from"] + np.cumsum(size_b[self.b])
        low = min(row["a_from"], row["b_from"])
        high = max(self.a_ends[-1] if len(self.a) else low, self.b_ends[-1] if len(self.b) else low)
        # A mark per byte of the piece says which B token ends there.
        mark = np.zeros(high - low + 1, np.int32)
        mark[self.b_ends - low] = np.arange(1, len(self.b) + 1)
        met = mark[self.a_ends - low]
        self.at_a = np.flatnonzero(met)
        self.at_b = met[self.at_a].astype(np.int64) - 1

    def links(self, voc: Vocabularies) -> np.ndarray:
        return voc.link(self.a[self.at_a], self.b[self.at_b])


def _count(vocabularies):
    def run(batches):
        voc: Vocabularies = vocabularies.value
        total, b_of = np.zeros(voc.links, np.int64), np.zeros(voc.links, np.int32)
        for batch in batches:
            for row in batch.to_pylist():
                piece = Piece(voc, row)
                links = piece.links(voc)
                b_of[links] = piece.b[piece.at_b]
                some, n = np.unique(links, return_counts=True)
                total[some] += n
        have = np.flatnonzero(total)
        for i in range(0, len(have), 1 << 16):
            part = have[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(b_of[part]), pa.array(total[part])], names=["link", "b", "n"])
        give_back_memory()

    return run


SUMS = ["n_a", "n_b", "n_links", "n_best", "count_sum"]
FOUND = "row long, key {kind}, piece int, whole boolean, " + ", ".join(f"{c} long" for c in SUMS) + ", sha string, groups binary, cut_left boolean, head_a binary, head_b binary, tail_a binary, tail_b binary"


def _written(tokens: int, ends: bytes) -> list[np.ndarray]:
    """Ids in decimal with each of the separators, of one width."""
    return [np.array([f"{i}{chr(e)}" for i in range(tokens)], f"S{len(str(tokens)) + 1}") for e in ends]


def _emit(vocabularies, scores):
    """Per piece and document: what lies inside the piece."""

    def run(batches):
        voc: Vocabularies = vocabularies.value
        counts, is_best = scores.value
        text_a, text_b = _written(len(voc.a), b",|"), _written(len(voc.b), b",;")
        width = max(text_a[0].itemsize, text_b[0].itemsize)
        for batch in batches:
            kind = batch.schema.field("keys").type.value_type
            for row in batch.to_pylist():
                p = Piece(voc, row)
                links = p.links(voc)
                meets = p.a_ends[p.at_a]
                ends = np.array(row["ends"], np.int64)
                of_a, of_b, of_links = (np.concatenate([[0], np.searchsorted(e, ends, "right")]) for e in (p.a_ends, p.b_ends, meets))
                sums = [np.concatenate([[0], np.cumsum(v)])[of_links] for v in (is_best[links], counts[links])]
                done_a, done_b = (int(p.at_a[-1]) + 1, int(p.at_b[-1]) + 1) if len(links) else (0, 0)
                # A's tokens of a group, then B's: where each token is written.
                shut_a, shut_b = np.zeros(done_a, bool), np.zeros(done_b, bool)
                shut_a[p.at_a] = True
                shut_b[p.at_b] = True
                group_a, group_b = np.cumsum(shut_a) - shut_a, np.cumsum(shut_b) - shut_b
                b_before = np.concatenate([[0], p.at_b + 1])
                written = np.empty(done_a + done_b, f"S{width}")
                a, b = p.a[:done_a], p.b[:done_b]
                written[np.arange(done_a) + b_before[group_a]] = np.where(shut_a, text_a[1][a], text_a[0][a])
                written[np.arange(done_b) + p.at_a[group_b] + 1] = np.where(shut_b, text_b[1][b], text_b[0][b])
                out: dict[str, list] = {c: [] for c in ["row", "key", "whole", *SUMS, "sha", "groups", "cut_left", "head_a", "head_b", "tail_a", "tail_b"]}
                start = row["base"]
                for k, (number, key, end) in enumerate(zip(row["rows"], row["keys"], row["ends"], strict=True)):
                    x, y = (of_a[k], of_b[k]), (of_a[k + 1], of_b[k + 1])
                    n = int(of_links[k + 1] - of_links[k])
                    cut_left = k == 0 and max(row["a_from"], row["b_from"]) > start
                    reach = [e[-1] if len(e) else f for e, f in ((p.a_ends, row["a_from"]), (p.b_ends, row["b_from"]))]
                    cut_right = end > start and min(reach) < end
                    # Tokens up to the first common end go to the group that was open, those
                    # behind the last one stay open.
                    head = (int(p.at_a[of_links[k]]) + 1, int(p.at_b[of_links[k]]) + 1) if n and cut_left else y if cut_left else x
                    tail = (int(p.at_a[of_links[k + 1] - 1]) + 1, int(p.at_b[of_links[k + 1] - 1]) + 1) if n else head
                    body = written[sum(head) : sum(tail)].tobytes().translate(None, b"\x00") if n else b""
                    whole = not (cut_left or cut_right)
                    values = [number, key, whole, y[0] - x[0], y[1] - x[1], n, int(sums[0][k + 1] - sums[0][k]), int(sums[1][k + 1] - sums[1][k])]
                    values.append((hashlib.sha256(body[:-1]).hexdigest() if n else "") if whole else None)
                    values += [None if whole else body, cut_left]
                    values += [None] * 4 if whole else [v.astype("<i4").tobytes() for v in (p.a[x[0] : head[0]], p.b[x[1] : head[1]], p.a[tail[0] : y[0]], p.b[tail[1] : y[1]])]
                    for c, v in zip(out, values, strict=True):
                        out[c].append(v)
                    start = end
                types = [pa.int64(), kind, pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.bool_(), *[pa.binary()] * 4]
                arrays = {c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)}
                arrays["piece"] = pa.array([row["piece"]] * len(out["row"]), pa.int32())
                names = ["row", "key", "piece", "whole", *SUMS, "sha", "groups", "cut_left", "head_a", "head_b", "tail_a", "tail_b"]
                yield pa.RecordBatch.from_arrays([arrays[c] for c in names], names=names)
        give_back_memory()

    return run


class Stitcher:
    """A document's boundary parts, in order; holds the open group only."""

    def __init__(self, row: dict):
        self.key, self.sums = row["key"], [0] * len(SUMS)
        self.digest, self.empty = hashlib.sha256(), True
        self.open: tuple[list, list] = ([], [])

    def write(self, groups: bytes) -> None:
        if groups:
            self.digest.update(groups[:-1] if self.empty else b";" + groups[:-1])
            self.empty = False

    def add(self, row: dict) -> None:
        self.sums = [s + row[c] for s, c in zip(self.sums, SUMS, strict=True)]
        for side, c in zip(self.open, ("head_a", "head_b"), strict=True):
            side.extend(np.frombuffer(row[c], "<i4").tolist())
        if row["n_links"]:
            if row["cut_left"]:
                self.write("|".join(",".join(map(str, side)) for side in self.open).encode() + b";")
            self.write(row["groups"])
            self.open = ([], [])
        for side, c in zip(self.open, ("tail_a", "tail_b"), strict=True):
            side.extend(np.frombuffer(row[c], "<i4").tolist())


def _stitch(batches):
    names = ["key", *SUMS, "sha"]
    at, number, schema = None, None, None

    def rows(done):
        columns = [[d.key for d in done], *([d.sums[i] for d in done] for i in range(len(SUMS))), [d.digest.hexdigest() for d in done]]
        return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(columns, names, strict=True)], names=names)

    for batch in batches:
        schema, done = batch.schema, []
        for i in range(batch.num_rows):
            row = {c: batch[c][i].as_py() for c in batch.schema.names}
            if row["row"] != number:
                if at is not None:
                    done.append(at)
                at, number = Stitcher(row), row["row"]
            at.add(row)
        if done:
            yield rows(done)
    if at is not None:
        yield rows([at])


@dataclass(frozen=True)
class Aligned:
    """``pieces``: stored pieces of the merges. ``counts``: link, b, n over all texts.
    ``documents``: the key, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of every row."""

    pieces: DataFrame
    counts: DataFrame
    documents: DataFrame


def align(
    df: DataFrame, a_file: str, b_file: str, a_ranks: str | None = None, key: str = "doc_id", text: str = "text", work: int = WORK, slice_bytes: int = SLICE_BYTES
) -> Aligned:
    """Aligns a byte-level BPE file (A) and a sentencepiece model (B) on every text."""
    spark = df.sparkSession
    voc = Vocabularies(byte_level_tokens(a_file), piece_tokens(b_file))
    if voc.links > MOST_LINKS:
        raise ValueError(f"the vocabularies allow {voc.links} links; counts of at most {MOST_LINKS} are sent to every task")
    vocabularies = spark.sparkContext.broadcast(voc)  # the two vocabularies
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    pieces = stored(rows.mapInArrow(_tokenise(a_file, a_ranks, b_file, vocabularies, work, slice_bytes), PIECE.format(kind=kind)), "pieces")
    counts = pieces.mapInArrow(_count(vocabularies), "link long, b int, n long").groupBy("link", "b").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most MOST_LINKS rows, by the vocabularies
    n, b, at = (np.asarray(table[c].combine_chunks() if table.num_rows else [], np.int64) for c in ("n", "b", "link"))
    highest = np.zeros(len(voc.b), np.int64)
    np.maximum.at(highest, b, n)
    score, is_best = np.zeros(voc.links, np.int64), np.zeros(voc.links, np.int64)
    score[at], is_best[at] = n, n == highest[b]
    scores = spark.sparkContext.broadcast((score, is_best))
    found = stored(pieces.mapInArrow(_emit(vocabularies, scores), FOUND.format(kind=kind)), "aligned")
    columns = ["key", *SUMS, "sha"]
    parts = found.filter(~F.col("whole")).drop("whole", "sha").withColumn("sha", F.lit(""))
    sent = parts.repartition(shuffle_tasks(spark), "row").sortWithinPartitions("row", "piece")
    stitched = sent.mapInArrow(_stitch, f"key {kind}, " + ", ".join(f"{c} long" for c in SUMS) + ", sha string")
    both = found.filter("whole").select(*columns).unionByName(stitched)
    documents = both.select(
        F.col("key").alias(key), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256")
    )
    return Aligned(pieces, counts, documents)
