"""A folder with one text file per document."""

from __future__ import annotations

import hashlib
import json
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corpusprep.functions.strings import file_path, file_stem, unique_stem

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


MANIFEST = "_manifest.json"
#: With a manifest, a task starts a new folder after so many files.
FILES_PER_FOLDER = 10_000


class NameCollision(ValueError):
    """Several documents would be written to one file."""


def export_name_collisions(df: DataFrame, id_col: str) -> DataFrame:
    """The file names that more than one row would get, with their row counts."""
    counts = df.groupBy(file_stem(id_col).alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter("n_rows > 1")


@dataclass
class _Done(WriterCommitMessage):
    folder: str


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark's own readers and writers would use,
    so that a bare path on a cluster never ends on one executor's disk."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(target).toString()


def _creator(fs: pafs.FileSystem) -> Callable:
    """On a mounted folder the system's own files cost least."""
    return (lambda path: open(path, "wb", buffering=0)) if isinstance(fs, pafs.LocalFileSystem) else fs.open_output_stream


def _write_text(create: Callable, path: str, text: str) -> None:
    with create(path) as out:
        data = memoryview(text.encode("utf-8"))
        while len(data):
            data = data[out.write(data) or len(data) :]


class _TextFolderWriter(DataSourceArrowWriter):
    """Tasks write every file under a temporary name and move it to its own name
    in a staging folder. A task that runs again, or twice at once, replaces its
    files by equal ones. The driver then moves the one folder into place: its
    work does not grow with the number of files. A folder that is replaced comes
    back when the move fails."""

    def __init__(self, path: str, overwrite: bool, spread: bool = False) -> None:
        self.path = path.rstrip("/")
        self.overwrite = overwrite
        self.spread = spread
        # Siblings of the target, so that the moves stay in one file system.
        token = uuid.uuid4().hex
        self.stage = f"{self.path}.stage-{token}"
        self.parts = f"{self.path}.parts-{token}"
        self.old = f"{self.path}.old-{token}"
        fs, target = _open(self.path)
        if not overwrite and fs.get_file_info(target).type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists; use mode 'overwrite' to replace it")
        for folder in (self.stage, self.parts):
            fs.create_dir(_open(folder)[1])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, stage = _open(self.stage)
        # A folder for each attempt, so that tasks do not wait for each other's entries.
        part = f"{_open(self.parts)[1]}/{uuid.uuid4().hex}/part"
        fs.create_dir(part.removesuffix("/part"))
        create, move = _creator(fs), os.replace if isinstance(fs, pafs.LocalFileSystem) else fs.move
        made = set()
        for batch in iterator:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder = f"{stage}/{hashlib.md5(name.encode()).hexdigest()[:2]}" if self.spread else stage
                if self.spread and folder not in made:
                    fs.create_dir(folder)
                    made.add(folder)
                _write_text(create, part, text)
                move(part, f"{folder}/{name}.txt")
        return _Done(stage)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, target = _open(self.path)
        if any(m is not None and m.folder != _open(self.stage)[1] for m in messages):
            raise RuntimeError(f"tasks wrote elsewhere than {self.stage}")
        replaced = fs.get_file_info(target).type != pafs.FileType.NotFound
        if replaced:
            if not self.overwrite:
                raise FileExistsError(f"{self.path} appeared during the write")
            fs.move(target, _open(self.old)[1])
        try:
            fs.move(_open(self.stage)[1], target)
        except BaseException:
            if replaced:
                fs.move(_open(self.old)[1], target)
            raise
        self._remove(self.parts, self.old)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove(self.stage, self.parts)

    def _remove(self, *folders: str) -> None:
        for folder in folders:
            fs, path = _open(folder)
            if fs.get_file_info(path).type != pafs.FileType.NotFound:
                fs.delete_dir(path)


def _write_parts(uri: str):
    """Every attempt of a task writes its files, under their own names, into folders that
    are its alone, and returns these; nothing is renamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(uri)
        create = _creator(fs)
        attempt, folders, files = f"part-{uuid.uuid4().hex}", [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if files % FILES_PER_FOLDER == 0:
                    folders.append(f"{attempt}-{len(folders)}")
                    fs.create_dir(f"{root}/{folders[-1]}")
                _write_text(create, f"{root}/{folders[-1]}/{name}.txt", text)
                files += 1
        yield pa.RecordBatch.from_pydict({"folder": pa.array(folders, pa.string())})

    return run


def _write_with_manifest(named: DataFrame, uri: str, overwrite: bool) -> None:
    """Puts a manifest of the folders of those attempts that Spark took into place.
    Readers follow it, so they see all of a write or nothing of it, and what other
    attempts left is never read."""
    fs, root = _open(uri)
    if not overwrite and fs.get_file_info(root).type != pafs.FileType.NotFound:
        raise FileExistsError(f"{uri} exists; use mode 'overwrite' to replace it")
    fs.create_dir(root)
    folders = [r[0] for r in named.mapInArrow(_write_parts(uri), "folder string").collect()]
    before = _listed_folders(uri) or []
    if before and not overwrite:
        raise FileExistsError(f"{uri} appeared during the write")
    draft = f"{root}/{MANIFEST}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(json.dumps({"folders": sorted(folders)}).encode())
    fs.move(draft, f"{root}/{MANIFEST}")
    for folder in before:
        if fs.get_file_info(f"{root}/{folder}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/{folder}")


def _listed_folders(uri: str) -> list[str] | None:
    """The folders that the manifest lists, or None where there is no manifest."""
    fs, root = _open(uri)
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())["folders"]


class TextFolderSink(DataSource):
    """``df.write.format("textfolder").save(path)`` for columns name and text."""

    @classmethod
    def name(cls) -> str:
        return "textfolder"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _TextFolderWriter(self.options["path"], overwrite, self.options.get("spread") == "true")


# Names that Spark's file readers skip (the first two) or cannot open.
_UNREADABLE = r"^$|^[._]|:"


def write_text_folder(
    df: DataFrame,
    id_col: str,
    text_col: str,
    path: str,
    collisions: str = "error",
    unreadable: str = "error",
    mode: str = "error",
    spread: bool = False,
    observation: Observation | None = None,
    commit: str = "move",
) -> DataFrame:
    """Writes each row's text to ``<path>/<stem of the id>.txt`` and returns the
    manifest: ``name`` and ``path`` of each file. ``spread`` puts files into 256
    folders below, by a digest of the name, for corpora that would overfill one.

    Rows with null text or id are not written; ``observation`` receives ``in_rows``
    and ``dropped_rows`` from the write itself. When two ids share a stem, ``error``
    stops before anything is written, and ``suffix`` adds a digest of the id to every
    name. Names that Spark could not read back (empty, with ``.`` or ``_`` in front,
    or with ``:``) are an error too, unless ``unreadable="keep"``. Of each kind the
    first names are told, always the same.

    ``commit="move"`` moves every file to ``path`` and needs a file system with a folder
    move, such as a mount that all executors share, or HDFS. ``commit="manifest"`` moves
    nothing and works in object stores too: files lie in one folder per task below
    ``path``, and ``read_text_folder`` reads the folders that the manifest lists. One
    file per document is slow where objects are costly: ``write_jsonl`` makes shards.
    """
    if commit not in ("move", "manifest") or (spread and commit == "manifest"):
        raise ValueError(f"commit must be 'move' or, without spread, 'manifest', not {commit!r}")
    if collisions not in ("error", "suffix") or unreadable not in ("error", "keep"):
        raise ValueError(f"unknown collisions={collisions!r} or unreadable={unreadable!r}")
    if mode not in ("error", "overwrite"):
        raise ValueError(f"mode must be 'error' or 'overwrite', not {mode!r}")
    stem = unique_stem if collisions == "suffix" else file_stem
    kept = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    present = df.filter(kept)
    name = stem(F.col(id_col).cast("string")).alias("name")

    def bad_names(names: DataFrame) -> tuple[list[str], list[str]]:
        lost = F.lit(False) if unreadable == "keep" else F.col("name").rlike(_UNREADABLE)
        counts = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumn("lost", lost).filter("n > 1 or lost")
        told = lambda test: [r["name"] for r in counts.filter(test).orderBy("name").limit(5).collect()]
        return told("n > 1"), told("lost")

    # First over all ids, which reads no text; only if that finds something, again
    # without the rows that have none.
    found = bad_names(df.filter(F.col(id_col).isNotNull()).select(name))
    shared, lost = bad_names(present.select(name)) if any(found) else ([], [])
    if shared:
        raise NameCollision(f"names of several rows, such as {shared}" + (f"; names that Spark cannot read back, such as {lost}" if lost else ""))
    if lost:
        raise ValueError(f"names that Spark cannot read back, such as {lost}")

    spark = df.sparkSession
    rows = df
    if observation is not None:
        rows = df.observe(observation, F.count(F.lit(1)).alias("in_rows"), F.count_if(~kept).alias("dropped_rows"))
    named = rows.filter(kept).select(name, F.col(text_col).alias("text"))
    if commit == "manifest":
        _write_with_manifest(named, _qualified(spark, path), mode == "overwrite")
        return _text_files(spark, path).select(_name_of_file().alias("name"), F.col("path"))
    spark.dataSource.register(TextFolderSink)
    spark_mode = "append" if mode == "error" else "overwrite"
    named.write.format("textfolder").option("spread", str(spread).lower()).mode(spark_mode).save(_qualified(spark, path))
    folder = F.concat(F.lit(path.rstrip("/") + "/"), F.substring(F.md5("name"), 1, 2), F.lit("/"), "name", F.lit(".txt"))
    return present.select(name).select("name", (folder if spread else file_path(path, "name")).alias("path"))


def _text_files(spark: SparkSession, path: str) -> DataFrame:
    """The ``.txt`` files below ``path`` as bytes; those that the manifest lists, if there
    is one. Spark counts a small file as ``spark.sql.files.openCostInBytes``, which makes a
    task of a few; here tasks are at most as many as shuffles have parts, or cores."""
    listed = _listed_folders(_qualified(spark, path))
    root = path.rstrip("/")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true")
    if listed == []:
        return reader.load(root).filter("false")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return reader.load(root if listed is None else [f"{root}/{folder}" for folder in listed]).coalesce(tasks)


def _name_of_file() -> Column:
    name = F.regexp_replace("_metadata.file_name", r"\.txt$", "")
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_text_folder(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``name`` and ``text`` of every ``.txt`` file, one row per file, also of files in
    folders below; where a write left a manifest, of the files that it lists. Spark's
    file readers skip files without a byte.

    Bytes that are no UTF-8 become replacement characters, unless ``strict``: then such
    a file has null text, and a column ``fault`` says where the first such byte is."""
    files = _text_files(spark, path)
    raw = F.col("content").cast("string")
    if not strict:
        return files.select(_name_of_file().alias("name"), F.make_valid_utf8(raw).alias("text"))
    valid = F.is_valid_utf8(raw)
    fault = F.when(~valid, F.concat(F.lit("not UTF-8 from byte "), _first_bad_byte(raw)))
    return files.select(_name_of_file().alias("name"), F.when(valid, raw).alias("text"), fault.alias("fault"))


def _first_bad_byte(raw: Column) -> Column:
    """A text may hold replacement characters of its own before its first bad byte: those
    are three bytes that stay, a bad byte is not."""
    own = F.lit("\ufffd").cast("binary")
    pieces = F.split(F.make_valid_utf8(raw), "\ufffd", -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("bad"), F.lit(True).alias("first"))
    content = raw.cast("binary")

    def step(state: Column, piece: Column) -> Column:
        # Behind every piece but the first lies a replacement character, own or not.
        here = F.substring(content, state["at"] + 1, 3) == own
        bad = state["bad"] | (~state["first"] & ~here)
        at = state["at"] + F.when(state["first"], 0).otherwise(3) + F.octet_length(piece)
        return F.when(bad, F.struct(state["at"].alias("at"), F.lit(True).alias("bad"), F.lit(False).alias("first"))).otherwise(
            F.struct(at.cast("int").alias("at"), F.lit(False).alias("bad"), F.lit(False).alias("first"))
        )

    return F.aggregate(pieces, start, step)["at"].cast("string")
