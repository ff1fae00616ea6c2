"""Packed samples as binary shards with an index: what a training loader reads.

Shard k of a split holds the samples k * n to (k + 1) * n - 1, so what is in a shard
does not depend on the partitioning. A shard file is

    payloads | sample numbers | offsets | count | magic

(64-bit little-endian numbers; ``offsets`` has one more entry than there are samples).
Integer tokens are the payload as they are, 32 or 64 bits each; strings are a count,
their lengths and their UTF-8 bytes. ``manifest.parquet`` lists the shards of the last
complete write with the numbers they hold. Tasks write files under names of their own,
the driver then writes the manifest and moves it into place, in one step: readers see
all of a write or nothing of it, and files of lost or doubled tasks are in no manifest.
No folder is moved.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from corpusprep.sources.text_folder import _open, _qualified

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"samples1"
MANIFEST = "manifest.parquet"
#: 4096 samples of 2048 tokens in 32 bits are 32 MB.
SHARD_SAMPLES = 4096
KINDS = {"int": ("<i4", pa.int32()), "bigint": ("<i8", pa.int64()), "string": (None, pa.string())}
ROWS_AT_ONCE = 1024
#: A task hands on so many bytes at once, and reads shards up to so many bytes.
BYTES_AT_ONCE, BYTES_OF_TASK = 16 << 20, 64 << 20
_LISTED = pa.schema([("split", pa.string()), ("shard", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("samples", pa.int64()), ("bytes", pa.int64()), ("file", pa.string()), ("kind", pa.string())])


def _packed(kind: str, tokens: pa.ListArray) -> Iterator[bytes]:
    """The payloads of a batch's samples, cut out of its buffers."""
    at = np.asarray(tokens.offsets).astype(np.int64)
    values = tokens.values.slice(at[0], at[-1] - at[0])
    at -= at[0]
    if values.null_count:
        raise ValueError("a sample holds a null token")
    if kind != "string":
        numbers = np.asarray(values).astype(KINDS[kind][0])
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield numbers[a:b].tobytes()
        return
    values.validate(full=True)  # UTF-8
    bounds, data = np.zeros(1, np.int64), b""
    if len(values):
        _, ends, data = values.buffers()
        width = np.int64 if pa.types.is_large_string(values.type) else np.int32
        bounds = np.frombuffer(ends, width)[values.offset : values.offset + len(values) + 1]
    sizes, raw = np.diff(bounds).astype("<i4"), memoryview(data or b"")
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield b"".join([np.array([b - a], "<i4").tobytes(), sizes[a:b].tobytes(), raw[bounds[a] : bounds[b]]])


def _unpack(kind: str, payload: bytes) -> np.ndarray | list[str]:
    if kind != "string":
        return np.frombuffer(payload, KINDS[kind][0])
    n = int(np.frombuffer(payload, "<i4", 1)[0])
    at = 4 + 4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(payload, "<i4", n, 4))]).astype(np.int64)
    return [payload[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]


def _unpacked(kind: str, payloads: Sequence[memoryview]) -> pa.ListArray:
    """The samples of payloads as one array, without an object for a token."""
    ends = lambda sizes: np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    if kind != "string":
        dtype = np.dtype(KINDS[kind][0])
        values = pa.array(np.frombuffer(b"".join(payloads), dtype), KINDS[kind][1])
        return pa.ListArray.from_arrays(pa.array(ends([len(p) // dtype.itemsize for p in payloads])), values)
    counts = [int.from_bytes(p[:4], "little") for p in payloads]
    sizes = np.frombuffer(b"".join(p[4 : 4 + 4 * n] for p, n in zip(payloads, counts, strict=True)), "<i4")
    data = b"".join(p[4 + 4 * n :] for p, n in zip(payloads, counts, strict=True))
    values = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends(sizes)), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(ends(counts)), values)


@dataclass
class _Written(WriterCommitMessage):
    shards: list[dict] = field(default_factory=list)


class _Open:
    """A shard that is being written."""

    def __init__(self, fs: pafs.FileSystem, root: str, split: str, shard: int, kind: str) -> None:
        folder = quote(split, safe="")
        file = f"{shard:08d}-{uuid.uuid4().hex}.bin"
        self.row = {"split": split, "shard": shard, "kind": kind, "file": f"{folder}/{file}" if folder else file}
        fs.create_dir(f"{root}/{folder}")
        self.out = fs.open_output_stream(f"{root}/{self.row['file']}")
        self.numbers: list[int] = []
        self.offsets = [0]

    def add(self, number: int, payload: bytes) -> None:
        if self.numbers and number <= self.numbers[-1]:
            raise ValueError(f"sample {number} comes twice or out of order in split {self.row['split']!r}")
        self.out.write(payload)
        self.numbers.append(number)
        self.offsets.append(self.offsets[-1] + len(payload))

    def close(self) -> dict:
        tail = np.array([*self.numbers, *self.offsets, len(self.numbers)], "<i8").tobytes() + MAGIC
        self.out.write(tail)
        self.out.close()
        return self.row | {"first": self.numbers[0], "last": self.numbers[-1], "samples": len(self.numbers), "bytes": self.offsets[-1] + len(tail)}


class _ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, kind: str) -> None:
        self.path, self.overwrite, self.kind = path.rstrip("/"), overwrite, kind
        fs, root = _open(self.path)
        if not overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} holds samples; use mode 'overwrite' to replace them")
        fs.create_dir(root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _open(self.path)
        done, at = _Written(), None
        for batch in iterator:
            splits, shards, numbers = (batch.column(i).to_pylist() for i in range(3))
            for split, shard, number, payload in zip(splits, shards, numbers, _packed(self.kind, batch.column(3)), strict=True):
                if at is None or (at.row["split"], at.row["shard"]) != (split, shard):
                    if at is not None:
                        done.shards.append(at.close())
                    at = _Open(fs, root, split, shard, self.kind)
                at.add(number, payload)
        if at is not None:
            done.shards.append(at.close())
        return done

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _open(self.path)
        before = _manifest(self.path).to_pylist() if fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.NotFound else []
        if before and not self.overwrite:
            raise FileExistsError(f"{self.path} got samples during the write")
        shards = sorted((s for m in messages if m is not None for s in m.shards), key=lambda s: (s["split"], s["shard"]))
        names = [(s["split"], s["shard"]) for s in shards]
        if len(set(names)) != len(names):
            raise RuntimeError("a shard was written by two tasks")
        draft = f"{root}/{MANIFEST}.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            pq.write_table(pa.Table.from_pylist(shards, _LISTED), out)
        fs.move(draft, f"{root}/{MANIFEST}")
        self._remove(before)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove([s for m in messages if m is not None for s in m.shards])

    def _remove(self, shards: list[dict]) -> None:
        fs, root = _open(self.path)
        for s in shards:
            if fs.get_file_info(f"{root}/{s['file']}").type != pafs.FileType.NotFound:
                fs.delete_file(f"{root}/{s['file']}")


def _manifest(path: str) -> pa.Table:
    fs, root = _open(path)
    with fs.open_input_file(f"{root}/{MANIFEST}") as f:
        return pq.read_table(f)


def drop_unlisted(path: str) -> int:
    """Deletes shard files that are in no manifest, which lost tasks and failed writes
    leave, and returns how many; not while a write runs."""
    fs, root = _open(path if ":" in path else f"file:{path}")
    listed = {f"{root}/{r['file']}" for r in _manifest(path if ":" in path else f"file:{path}").to_pylist()}
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    lost = [f.path for f in found if f.type == pafs.FileType.File and f.path.endswith(".bin") and f.path not in listed]
    for f in lost:
        fs.delete_file(f)
    return len(lost)


class Shard:
    """The samples of one shard file; a sample is read alone, by its offset."""

    def __init__(self, path: str, row: dict) -> None:
        fs, root = _open(path)
        self.kind = row["kind"]
        self.file = fs.open_input_file(f"{root}/{row['file']}")
        size = 8 * (2 * row["samples"] + 2) + len(MAGIC)
        tail = self.file.read_at(size, row["bytes"] - size)
        numbers = np.frombuffer(tail, "<i8", len(tail) // 8 - 1)
        if tail[-len(MAGIC) :] != MAGIC or numbers[-1] != row["samples"]:
            raise ValueError(f"{row['file']} is no shard with {row['samples']} samples")
        self.numbers, self.offsets = numbers[: row["samples"]], numbers[row["samples"] : -1]

    def at(self, place: int) -> np.ndarray | list[str]:
        return _unpack(self.kind, self.file.read_at(int(self.offsets[place + 1] - self.offsets[place]), int(self.offsets[place])))

    def payloads(self, places: Sequence[int]) -> Iterator[memoryview]:
        """The payloads at the places, those that follow on each other in one read."""
        cuts = [i for i in range(1, len(places)) if places[i] != places[i - 1] + 1]
        for a, b in zip([0, *cuts], [*cuts, len(places)], strict=True):
            ends = self.offsets[places[a] : places[a] + b - a + 1].tolist()
            raw = memoryview(self.file.read_at(ends[-1] - ends[0], ends[0]))
            for begin, end in zip(ends[:-1], ends[1:], strict=True):
                yield raw[begin - ends[0] : end - ends[0]]

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Places of those wanted numbers that are here."""
        at = np.minimum(np.searchsorted(self.numbers, wanted), len(self.numbers) - 1)
        return at[self.numbers[at] == wanted]


class SampleShards(Sequence):
    """Samples of one split by number, without Spark, as a loader on a training host
    reads them. ``shards[i]`` reads the bytes of that sample only."""

    def __init__(self, path: str, split: str = "") -> None:
        self.path = path if ":" in path else f"file:{path}"
        self.rows = [r for r in _manifest(self.path).to_pylist() if r["split"] == split]
        self.firsts = np.array([r["first"] for r in self.rows], np.int64)
        self._open: dict[int, Shard] = {}

    def __len__(self) -> int:
        return sum(r["samples"] for r in self.rows)

    def __getitem__(self, number: int) -> np.ndarray | list[str]:
        at = int(np.searchsorted(self.firsts, number, "right")) - 1
        if at >= 0 and at not in self._open:
            self._open[at] = Shard(self.path, self.rows[at])
        place = self._open[at].places(np.array([number])) if at >= 0 else []
        if not len(place):
            raise IndexError(f"no sample {number}")
        return self._open[at].at(int(place[0]))


@dataclass
class _Shards(InputPartition):
    """Windows of shards that one task reads one after the other, each with the position
    of its first sample, if samples have one."""

    windows: list[tuple[list[dict], int | None]]


class _ShardReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.split = options.get("split")
        self.seed, self.window = options.get("seed"), int(options.get("window", "1"))
        self.numbers = np.array(sorted(set(json.loads(options["numbers"]))), np.int64) if "numbers" in options else None
        self.tasks = int(options["tasks"])
        self.tokens = options.get("tokens") != "false"

    def partitions(self) -> Sequence[InputPartition]:
        rows = [r for r in _manifest(self.path).to_pylist() if self.split is None or r["split"] == self.split]
        if self.numbers is not None:
            low, high = (np.searchsorted(self.numbers, [r[c] for r in rows], s) for c, s in (("first", "left"), ("last", "right")))
            rows = [r for r, a, b in zip(rows, low, high, strict=True) if a < b]
        if self.seed is None:
            return self._dealt([([r], None) for r in rows])
        rows.sort(key=lambda r: (_digest(f"{self.seed}:shard:{r['shard']}"), r["shard"]))
        out, base = [], 0
        for i in range(0, len(rows), self.window):
            part = rows[i : i + self.window]
            out.append((part, base))
            base += sum(r["samples"] for r in part)
        return self._dealt(out)

    def _dealt(self, windows: list[tuple[list[dict], int | None]]) -> list[_Shards]:
        """Windows in their order, so many to a task that tasks grow with the bytes and not
        with the number of shards."""
        sizes = [sum(r["bytes"] for r in part) for part, _ in windows]
        most = min(BYTES_OF_TASK, sum(sizes) / self.tasks)
        out, filled = [_Shards([])], 0
        for window, size in zip(windows, sizes, strict=True):
            if filled and filled + size > most:
                out.append(_Shards([]))
                filled = 0
            out[-1].windows.append(window)
            filled += size
        return out

    def read(self, partition: _Shards) -> Iterator[pa.RecordBatch]:
        for shards, base in partition.windows:
            yield from self._read_window(shards, base)

    def _read_window(self, rows: list[dict], base: int | None) -> Iterator[pa.RecordBatch]:
        opened = [Shard(self.path, r) for r in rows]
        entries = []
        for s, (shard, row) in enumerate(zip(opened, rows, strict=True)):
            wanted = range(len(shard.numbers)) if self.numbers is None else shard.places(self.numbers).tolist()
            entries += [(s, p, int(shard.numbers[p]), row["split"]) for p in wanted]
        if base is not None:
            entries.sort(key=lambda e: (_digest(f"{self.seed}:{e[2]}"), e[2]))
        done = 0
        for part in self._at_once(opened, entries):
            columns = {"split": pa.array([e[3] for e in part], pa.string()), "sample": pa.array([e[2] for e in part], pa.int64())}
            if self.tokens:
                payloads = [x for s, places in _runs(part) for x in opened[s].payloads(places)]
                columns["tokens"] = _unpacked(rows[0]["kind"], payloads)
            if base is not None:
                columns["position"] = pa.array(range(base + done, base + done + len(part)), pa.int64())
            done += len(part)
            yield pa.RecordBatch.from_pydict(columns)

    def _at_once(self, opened: list[Shard], entries: list[tuple]) -> Iterator[list[tuple]]:
        """Entries in their order, of bounded number and bytes."""
        part, size = [], 0
        for e in entries:
            own = int(opened[e[0]].offsets[e[1] + 1] - opened[e[0]].offsets[e[1]])
            if part and (len(part) == ROWS_AT_ONCE or size + own > BYTES_AT_ONCE):
                yield part
                part, size = [], 0
            part.append(e)
            size += own
        if part:
            yield part


def _runs(entries: list[tuple]) -> Iterator[tuple[int, list[int]]]:
    """The places of entries that follow on each other in one shard."""
    for shard, some in groupby(entries, key=lambda e: e[0]):
        yield shard, [e[1] for e in some]


def _digest(text: str) -> str:
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


class SampleShardSource(DataSource):
    """``spark.read.format("sampleshards")`` and the writer behind ``write_shards``."""

    @classmethod
    def name(cls) -> str:
        return "sampleshards"

    def schema(self) -> str:
        listed = _manifest(self.options["path"].rstrip("/"))
        kind = listed["kind"][0].as_py() if listed.num_rows else "int"
        tokens = "" if self.options.get("tokens") == "false" else f", tokens array<{kind}>"
        return f"split string, sample bigint{tokens}" + (", position bigint" if "seed" in self.options else "")

    def reader(self, schema) -> DataSourceReader:
        return _ShardReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter(self.options["path"], overwrite, self.options["kind"])


def shard_of(sample: Column | str, shard_samples: int = SHARD_SAMPLES) -> Column:
    """The shard that a sample lies in."""
    sample = F.col(sample) if isinstance(sample, str) else sample
    return F.floor(sample / F.lit(shard_samples)).cast("bigint")


def write_shards(
    df: DataFrame, path: str, sample_col: str = "sample", tokens_col: str = "tokens", split_col: str | None = None, shard_samples: int = SHARD_SAMPLES, mode: str = "error"
) -> None:
    """Writes samples (a number and an array of int, bigint or string) as shards of
    ``shard_samples`` numbers each. Numbers are unique in a split and not null. Samples
    are shuffled once, to the task of their shard."""
    if mode not in ("error", "overwrite"):
        raise ValueError(f"mode must be 'error' or 'overwrite', not {mode!r}")
    kind = df.schema[tokens_col].dataType.simpleString().removeprefix("array<").removesuffix(">")
    if kind not in KINDS:
        raise TypeError(f"tokens must be an array of int, bigint or string, not of {kind}")
    spark = df.sparkSession
    spark.dataSource.register(SampleShardSource)
    split = F.lit("") if split_col is None else F.col(split_col).cast("string")
    number = F.when(F.col(sample_col).isNull(), F.raise_error(F.lit("a sample has no number"))).otherwise(F.col(sample_col)).cast("bigint")
    rows = df.select(F.coalesce(split, F.lit("null")).alias("split"), number.alias("sample"), F.coalesce(F.col(tokens_col), F.array().cast(f"array<{kind}>")).alias("tokens"))
    rows = rows.select("split", shard_of("sample", shard_samples).alias("shard"), "sample", "tokens")
    sent = rows.repartition("split", "shard").sortWithinPartitions("split", "shard", "sample")
    sent.write.format("sampleshards").option("kind", kind).mode("append" if mode == "error" else "overwrite").save(_qualified(spark, path))


def _reader(spark: SparkSession) -> DataFrameReader:
    spark.dataSource.register(SampleShardSource)
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return spark.read.format("sampleshards").option("tasks", str(tasks))


def read_shards(spark: SparkSession, path: str, split: str | None = None, numbers: Sequence[int] | None = None) -> DataFrame:
    """``split, sample, tokens``: all samples, those of one split, or those with the given
    numbers; then only shards that hold one are opened, and only its bytes read."""
    reader = _reader(spark)
    if split is not None:
        reader = reader.option("split", split)
    if numbers is not None:
        reader = reader.option("numbers", json.dumps([int(n) for n in numbers]))
    return reader.load(_qualified(spark, path))


def shuffled_shards(spark: SparkSession, path: str, split: str = "", seed: int = 17, window: int = 8, tokens: bool = True) -> DataFrame:
    """``split, sample, tokens, position``: the samples of a split in a seeded order that
    moves none of them between tasks. Shards are put in the order of their digests;
    ``window`` shards at a time, a task puts their samples in the order of theirs. It
    reads the windows' index and then one sample after the other. Windows of all shards
    give the order of ``shuffle_into_order``; see ``shuffle_spread`` for smaller ones.
    Without ``tokens`` only the index is read."""
    if window < 1:
        raise ValueError("a window has one shard at least")
    reader = _reader(spark).option("split", split).option("seed", str(seed)).option("window", str(window))
    return reader.option("tokens", str(tokens).lower()).load(_qualified(spark, path))


def shuffle_spread(positions: DataFrame, sample_col: str = "sample", position_col: str = "position") -> DataFrame:
    """How far an order is from a uniform shuffle of samples 0 to n - 1, in one row:
    ``n_samples``, ``moved`` (the mean distance between position and number, as a share
    of what a uniform shuffle has, (n * n - 1) / 3n), and ``kept_next`` (how many
    samples come right behind their predecessor)."""
    rows = positions.select(F.col(sample_col).alias("s"), F.col(position_col).alias("p"))
    before = rows.select((F.col("s") + 1).alias("s"), (F.col("p") + 1).alias("q"))
    paired = rows.join(before, "s", "left")
    n = F.count("*")
    moved = F.sum(F.abs(F.col("s") - F.col("p"))) * 3 / (n.cast("double") * n - 1)
    return paired.agg(n.alias("n_samples"), F.round(moved, 9).alias("moved"), F.count_if(F.col("q") == F.col("p")).alias("kept_next"))
