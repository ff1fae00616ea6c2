"""Exact deduplication over an extendible-hash index on shared files.

The index holds one entry per distinct text, in buckets named by the first bits of the
text's hash. A directory of 2^d pointers says which bucket has which bits; a bucket
above its capacity splits by the next bit, and the directory doubles when the bucket
already used all of its bits. Buckets split by counting narrow (hash, bytes) rows, one
Spark job per round, before any text moves. Then every text goes to the task that owns
its range of keys (consecutive buckets of about equal bytes); the task walks its
entries in the order of their hashes, compares bytes, and chains texts that differ
behind one hash. It holds the texts of one hash at a time, so a bucket that cannot
split, as all its hashes are equal, only gets longer.

Tasks send the first of equal texts with a count, so copies without end are a row per
task. Rows then look their entry up: entries with more than a 1024th of all rows, at
most 1024, by broadcast, and all others by a shuffle.

Files below ``path``: ``buckets/generation=g``, written by the owners, and
``directory/generation=g``, written behind them. The last complete directory counts, so
a batch that failed halfway leaves the index as it was. One writer at a time.

Defined results: null text is empty, and empty texts are equal; of equal texts the row
with the smallest key stays, a null key counts as the largest, and of rows with equal
text and key one stays; an empty table gives no rows; columns other than the two named
are not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import BLANKS, give_back_memory, shuffle_tasks, stored
from corpusprep.session import scratch_path

#: A bucket splits above so many bytes of text or so many hashes.
BUCKET_BYTES = 32 << 20
BUCKET_ENTRIES = 1 << 20
#: The directory doubles up to so many bits (4 MB of pointers, which tasks receive as a
#: broadcast). Where the data has more full buckets than that, the capacity grows.
MAX_DEPTH = 20
#: Entries with more than one in so many of all rows are looked up by broadcast.
HOT = 1024
#: Texts that a task keeps to find copies of before it starts anew.
SEEN_BYTES = 24 << 20
SLICE_ROWS = 2048

ENTRY = "bucket int, hash long, keep {kind}, n long, ties long, sha string, bytes long, text binary"


@dataclass(frozen=True)
class Bucket:
    """The texts whose hash starts with the ``depth`` bits of ``prefix``."""

    prefix: int
    depth: int
    generation: int = 0
    entries: int = 0
    bytes: int = 0


def pointers(buckets: list[Bucket]) -> tuple[np.ndarray, int]:
    """The directory: for every value of the first d bits the place of its bucket."""
    depth = max(1, max(b.depth for b in buckets))
    out = np.zeros(1 << depth, np.int32)
    for i, b in enumerate(buckets):
        out[b.prefix << (depth - b.depth) : (b.prefix + 1) << (depth - b.depth)] = i
    return out, depth


def split(bucket: Bucket, levels: int) -> list[Bucket]:
    return [Bucket((bucket.prefix << levels) + i, bucket.depth + levels, bucket.generation) for i in range(1 << levels)]


def normalised(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _place(directory, hashes: pa.Array) -> np.ndarray:
    table, depth = directory.value
    return table[(np.asarray(hashes).astype(np.int64).view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64)]


def _sizes(directory, n: int):
    """Sums per bucket of (hash, bytes) rows: a row per bucket and batch at most."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            place, size, value = _place(directory, batch["hash"]), np.asarray(batch["bytes"]), np.asarray(batch["hash"])
            have, at = np.unique(place, return_inverse=True)
            total, low, high = np.zeros(len(have), np.int64), np.full(len(have), 2**63 - 1), np.full(len(have), -(2**63))
            np.add.at(total, at, size)
            np.minimum.at(low, at, value)
            np.maximum.at(high, at, value)
            columns = [have.astype(np.int32), np.bincount(at).astype(np.int64), total, low, high]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "entries", "bytes", "low", "high"])

    return run


def _first_of_equal(directory, owners, kind: str):
    """Entries of a task's rows: the bucket and its owner, and each text once."""

    def run(batches):
        seen: dict[int, list] = {}
        kept = 0
        squeeze = zstandard.ZstdCompressor(level=1).compress
        types = [pa.int32(), pa.int32(), pa.int64(), None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def flush(id_type):
            entries = [e for chain in seen.values() for e in chain]
            for a in range(0, len(entries), SLICE_ROWS):
                part = entries[a : a + SLICE_ROWS]
                place = _place(directory, np.array([e[0] for e in part], np.int64))
                columns = [place, owners.value[place], *([e[i] for e in part] for i in range(6)), [squeeze(e[6]) for e in part]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, id_type if t is None else t) for c, t in zip(columns, types, strict=True)],
                    names=["bucket", "owner", "hash", "keep", "n", "ties", "sha", "bytes", "text"],
                )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                for key, value, sha, text in zip(*(part[c].to_pylist() for c in ("id", "hash", "sha", "text")), strict=True):
                    chain = seen.setdefault(value, [])
                    for entry in chain:
                        if entry[6] == text:
                            merge(entry, key, 1, 1)
                            break
                    else:
                        chain.append([value, key, 1, 1, sha, len(text), text])
                        kept += len(text) + 200
                    if kept > SEEN_BYTES:
                        yield from flush(id_type)
                        seen.clear()
                        kept = 0
        if seen:
            yield from flush(id_type)
        seen.clear()
        give_back_memory()

    return run


def merge(entry: list, key, n: int, ties: int) -> None:
    """Adds ``n`` rows, ``ties`` of which have the smallest key ``key``, to an entry
    (hash, keep, n, ties, ..)."""
    entry[2] += n
    if key == entry[1]:
        entry[3] += ties
    elif key is not None and (entry[1] is None or key < entry[1]):
        entry[1], entry[3] = key, ties


def _chain(batches):
    """An owner's work: rows come sorted by bucket and hash."""
    open_text = zstandard.ZstdDecompressor().decompress
    names = ["bucket", "hash", "keep", "n", "ties", "sha", "bytes", "text"]
    run: list[list] = []  # the entries of the hash at hand: (hash, keep, n, ties, bucket, sha, bytes, frame)
    schema = None

    def as_batch(rows):
        order = (4, 0, 1, 2, 3, 5, 6, 7)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(n).type) for i, n in zip(order, names, strict=True)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.select(names)
        schema = batch.schema
        done: list[list] = []
        for bucket, value, keep, n, ties, sha, size, frame in zip(*(batch[c].to_pylist() for c in names), strict=True):
            if run and run[0][0] != value:
                done += run
                run = []
            for entry in run:
                # Frames of one library are equal for equal texts; others are opened.
                if entry[6] == size and (entry[7] == frame or open_text(entry[7]) == open_text(frame)):
                    merge(entry, keep, n, ties)
                    break
            else:
                run.append([value, keep, n, ties, bucket, sha, size, frame])
        if done:
            yield as_batch(done)
    if run:
        yield as_batch(run)
    give_back_memory()


class ExactIndex:
    """An index of distinct texts below ``path``, a folder that every executor reaches.
    Batches are added one after the other with ``insert``."""

    def __init__(self, spark: SparkSession, path: str, hash_bits: int = 64, bucket_bytes: int = BUCKET_BYTES, bucket_entries: int = BUCKET_ENTRIES):
        self.spark, self.path, self.hash_bits = spark, path.rstrip("/"), hash_bits
        self.bucket_bytes, self.bucket_entries = bucket_bytes, bucket_entries
        self.kind, self.rounds = "long", 0
        self.generation, self.buckets = self._open()

    def _open(self) -> tuple[int, list[Bucket]]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/directory")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = [s.getPath().getParent().getName() for s in files.globStatus(hadoop.Path(f"{self.path}/directory/generation=*/_SUCCESS")) or []]
        if not done:
            return 0, []
        last = max(int(name.split("=")[1]) for name in done)
        table = self.spark.read.parquet(f"{self.path}/directory/generation={last}")
        return last, [Bucket(*r) for r in table.select("prefix", "depth", "generation", "entries", "bytes").collect()]  # a row per bucket

    def rows(self, df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Stored narrow rows: id, hash, sha, bytes and a number of their own."""
        body = normalised(text)
        out = df.select(F.col(key).alias("id"), body.alias("body"))
        out = out.select("id", self._hash("body").alias("hash"), F.sha2("body", 256).alias("sha"), F.octet_length("body").cast("long").alias("bytes"))
        return stored(out.withColumn("row", F.monotonically_increasing_id()), "exact-rows")

    def _hash(self, body: str) -> Column:
        """The first bits of the text's 64-bit hash."""
        return F.xxhash64(body).bitwiseAND(F.lit(-(1 << (64 - self.hash_bits))))

    def _grow(self, rows: DataFrame) -> list[Bucket]:
        """Splits buckets in rounds until none is above its capacity that can split."""
        spark = self.spark
        fresh = stored(rows.groupBy("hash", "sha").agg(F.max("bytes").alias("bytes")).select("hash", "bytes"), "exact-hashes")
        total = (fresh.agg(F.sum("bytes")).first()[0] or 0) + sum(b.bytes for b in self.buckets)
        room = max(self.bucket_bytes, total >> (MAX_DEPTH - 3))
        buckets, todo, hashes = self.buckets or [Bucket(0, 0)], None, fresh
        while todo is None or todo:
            table, depth = pointers(buckets)
            directory = spark.sparkContext.broadcast((table, depth))
            sums = hashes.mapInArrow(_sizes(directory, len(buckets)), "bucket int, entries long, bytes long, low long, high long").groupBy("bucket")
            found = sums.agg(F.sum("entries"), F.sum("bytes"), F.min("low"), F.max("high")).collect()  # a row per bucket
            self.rounds += 1
            old = dict(enumerate(self.buckets)) if todo is None else {}
            after, full = dict(enumerate(buckets)), []
            for at, entries, size, low, high in found:
                if todo is not None and at not in todo:
                    continue
                entries, size = entries + (old[at].entries if old else 0), size + (old[at].bytes if old else 0)
                over = max(size / room, entries / self.bucket_entries)
                levels = min(MAX_DEPTH - buckets[at].depth, max(1, int(np.ceil(np.log2(over)))) if over > 1 else 0)
                if over > 1 and levels > 0 and (low != high or old):
                    full.append((at, levels))
            children: list[Bucket] = []
            for at, levels in full:
                children += split(after.pop(at), levels)
            stay = list(after.values())
            buckets, todo = stay + children, set(range(len(stay), len(stay) + len(children)))
            if todo and self.buckets and hashes is fresh:  # entries of split buckets count from here on
                hashes = fresh.unionByName(self._live().select("hash", "bytes"))
            directory.unpersist()
        return buckets

    def _live(self) -> DataFrame:
        """Every entry that the current directory points to."""
        spark = self.spark
        kept = sorted({b.generation for b in self.buckets if b.entries})
        wanted = spark.createDataFrame([(b.prefix, b.depth, b.generation) for b in self.buckets if b.entries], "prefix long, depth int, generation int")
        parts = [spark.read.parquet(f"{self.path}/buckets/generation={g}").withColumn("generation", F.lit(g)) for g in kept]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        # At most 2^MAX_DEPTH buckets of 16 bytes.
        return out.join(F.broadcast(wanted), ["prefix", "depth", "generation"], "left_semi")

    def insert(self, df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Adds the texts of ``df``; returns its narrow rows for ``lookup``."""
        spark, tasks = self.spark, shuffle_tasks(self.spark)
        rows = self.rows(df, key, text)
        self.kind = dict(rows.dtypes)["id"]
        buckets, generation = self._grow(rows), self.generation + 1
        table, depth = pointers(buckets)
        directory = spark.sparkContext.broadcast((table, depth))
        # Owners: consecutive buckets, dealt by the hashes they stand for.
        order = np.array([b.prefix << (MAX_DEPTH - b.depth) for b in buckets], np.int64)
        owner = spark.sparkContext.broadcast((order * tasks >> MAX_DEPTH).astype(np.int32))
        body = normalised(text)
        texts = df.select(F.col(key).alias("id"), body.alias("body"))
        texts = texts.select("id", self._hash("body").alias("hash"), F.sha2("body", 256).alias("sha"), F.col("body").cast("binary").alias("text"))
        schema = "bucket int, owner int, hash long, keep {kind}, n long, ties long, sha string, bytes long, text binary".format(kind=self.kind)
        entries = texts.mapInArrow(_first_of_equal(directory, owner, self.kind), schema)
        if any(b.entries for b in self.buckets):
            # Buckets that get new texts, or have split, are written anew.
            touched = rows.select("hash", "bytes").mapInArrow(_sizes(directory, len(buckets)), "bucket int, entries long, bytes long, low long, high long")
            touched = {r[0] for r in touched.select("bucket").distinct().collect()}  # a row per bucket
            before = {(b.prefix, b.depth) for b in self.buckets}
            moved = {i for i, b in enumerate(buckets) if i in touched or (b.prefix, b.depth) not in before}
            places = np.zeros(len(buckets), bool)
            places[list(moved)] = True
            chosen = spark.sparkContext.broadcast(places)
            again = self._live().select("hash", "keep", "n", "ties", "sha", "bytes", "text").mapInArrow(_again(directory, owner, chosen), schema)
            entries = entries.unionByName(again)
        else:
            moved = set(range(len(buckets)))
        sent = entries.repartitionById(tasks, "owner").drop("owner").sortWithinPartitions("bucket", "hash", F.col("keep").asc_nulls_last())
        names = spark.sparkContext.broadcast((np.array([b.prefix for b in buckets], np.int64), np.array([b.depth for b in buckets], np.int32)))
        written = sent.mapInArrow(_chain, ENTRY.format(kind=self.kind)).mapInArrow(_named(names), "prefix long, depth int, " + ENTRY.format(kind=self.kind))
        target = f"{self.path}/buckets/generation={generation}"
        written.drop("bucket").write.mode("overwrite").parquet(target)
        sizes = spark.read.schema("prefix long, depth int, bytes long").parquet(target).groupBy("prefix", "depth").agg(F.count("*"), F.sum("bytes"))
        have = {(r[0], r[1]): (r[2], r[3]) for r in sizes.collect()}  # a row per bucket
        done = []
        for i, b in enumerate(buckets):
            if i in moved:
                entries_of, size = have.get((b.prefix, b.depth), (0, 0))
                b = replace(b, generation=generation, entries=entries_of, bytes=size)
            done.append(b)
        listed = [(b.prefix, b.depth, b.generation, b.entries, b.bytes) for b in done]
        spark.createDataFrame(listed, "prefix long, depth int, generation int, entries long, bytes long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/directory/generation={generation}"
        )
        self.generation, self.buckets = generation, done
        return rows

    def entries(self) -> DataFrame:
        """hash, keep (the smallest key), n (rows), ties (rows with that key), sha and the
        compressed text of every distinct text."""
        return self._live()

    def lookup(self, rows: DataFrame) -> DataFrame:
        """Adds to rows that ``insert`` returned: keep, n, first (the number of the row
        that stays where several have the smallest key, else null)."""
        if not any(b.entries for b in self.buckets):
            return rows.select("*", F.col("id").alias("keep"), F.lit(1).cast("long").alias("n"), F.lit(None).cast("long").alias("first"))
        every = self._live().select("hash", "sha", "keep", "n", "ties").filter("n > 1")
        found = every.withColumn("first", F.lit(None).cast("long"))
        if not every.filter("ties > 1").isEmpty():
            firsts = rows.groupBy(F.col("hash").alias("h"), F.col("sha").alias("s"), F.col("id").alias("i")).agg(F.min("row").alias("r"), F.count("*").alias("c"))
            same = (F.col("hash") == F.col("h")) & (F.col("sha") == F.col("s")) & F.col("keep").eqNullSafe(F.col("i")) & (F.col("ties") > 1)
            # More ties than rows here: one of an earlier batch stays.
            found = every.join(firsts, same, "left").withColumn("first", F.when(F.col("ties") > F.col("c"), F.lit(-1)).otherwise(F.col("r")))
        found = found.select("hash", "sha", "keep", "n", "first")
        total = self._live().agg(F.sum("n")).first()[0]
        hot, cold = found.filter(F.col("n") * HOT >= total), found.filter(F.col("n") * HOT < total)
        columns = ["id", "row", "hash", "sha", "bytes"]
        rows = rows.select(*columns)
        few = F.broadcast(hot)  # at most HOT rows, as their counts add up to the total
        near = rows.join(few, ["hash", "sha"]).select(*columns, "keep", "n", "first")
        far = rows.join(F.broadcast(hot.select("hash", "sha")), ["hash", "sha"], "left_anti").join(cold, ["hash", "sha"], "left")
        alone = F.col("n").isNull()
        far = far.select(*columns, F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"), F.coalesce("n", F.lit(1)).alias("n"), "first")
        return near.unionByName(far)


def _again(directory, owners, chosen):
    """Entries of the index that go to their owners once more."""

    def run(batches):
        for batch in batches:
            place = _place(directory, batch["hash"])
            mask = chosen.value[place]
            part = batch.filter(pa.array(mask))
            place = place[mask].astype(np.int32)
            names = ["hash", "keep", "n", "ties", "sha", "bytes", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(owners.value[place]), *(part[c] for c in names)], names=["bucket", "owner", *names])

    return run


def _named(names):
    def run(batches):
        for batch in batches:
            at = np.asarray(batch["bucket"])
            prefix, depth = names.value
            yield pa.RecordBatch.from_arrays([pa.array(prefix[at]), pa.array(depth[at]), *batch.columns], names=["prefix", "depth", *batch.schema.names])

    return run


def mark_copies(df: DataFrame, key: str = "doc_id", text: str = "text", index: ExactIndex | None = None) -> DataFrame:
    """Per row of ``df``: the key, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``. With an ``index``, texts of earlier batches count too."""
    index = index or ExactIndex(df.sparkSession, scratch_path(df.sparkSession, "exact-index"))
    found = index.lookup(index.insert(df, key, text))
    kept = F.col("id").eqNullSafe(F.col("keep")) & (F.col("first").isNull() | (F.col("first") == F.col("row")))
    return found.select(F.col("id").alias(key), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def copies_sql() -> str:
    return r"""
with texts as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents),
groups_ as (select body, min(doc_id) as keep_id, count(*) as group_size from texts group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256 from texts join groups_ using (body)"""
