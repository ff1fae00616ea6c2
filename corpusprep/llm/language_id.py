"""Language identification by the nearest of several centroids per language.

A text is a vector of its byte trigrams, hashed into ``DIMENSIONS`` places and taken
as ``log(1 + count) * idf`` at length 1. Training passes: document frequencies over
all texts that may be learned from; then a bounded sample per language (at most
``SAMPLE`` texts, those with the lowest hash of the key), which spherical k-means
clusters into ``CENTROIDS`` centroids, a task per language. What comes to the driver
is one number per dimension and the centroids. A prediction is the language of the
nearest centroid by cosine, in the pass over the texts that asks for it.

Rejection by distance: the cosine that all but ``STRAY`` of a language's sample reach
is its limit; a text below the limit of its nearest language is marked ``rejected``.
``lang_pred`` names the nearest language all the same.

Defined results: null text, or text without a letter, is ``und`` with score 0 and not
rejected; so is everything if there is nothing to learn from. Equal rows get equal
rows; a null key is carried through; only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusprep.llm.repeats import TEXT, text_slices

DIMENSIONS = 1 << 12
CENTROIDS = 4
SAMPLE = 400
ITERATIONS = 8
STRAY = 0.005
NO_LANGUAGE = "und"

#: Texts whose vectors are held at once (4096 numbers each).
TEXTS_AT_ONCE = 512


def _byte_map() -> np.ndarray:
    """Letters in lower case, bytes of other characters as they are, the rest blank."""
    table = np.full(256, 0x20, np.uint32)
    for c in range(26):
        table[0x41 + c] = table[0x61 + c] = 0x61 + c
    table[0x80:] = np.arange(0x80, 0x100)
    return table


BYTES = _byte_map()


def counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hashed trigram counts of texts that lie behind each other, a row per text. Each
    text counts as if it had a blank at both ends."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    chars = np.full(len(data) + 2 * n, 0x20, np.uint32)
    text = np.repeat(np.arange(n), sizes)
    chars[np.arange(len(data)) + 2 * text + 1] = BYTES[data]
    code = (chars[:-2] << np.uint32(16)) | (chars[1:-1] << np.uint32(8)) | chars[2:]
    # Trigrams that reach into the next text, and those of blanks, do not count.
    owner = np.repeat(np.arange(n), sizes + 2)[:-2]
    ok = (owner == np.repeat(np.arange(n), sizes + 2)[2:]) & (code != 0x202020)
    place = ((code * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)  # the top 12 bits
    return np.bincount(owner[ok] * DIMENSIONS + place[ok], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


def _slices(batch: pa.RecordBatch):
    """Parts of a batch, bounded in bytes and in texts, as each text has a full vector."""
    for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
        yield from text_slices(batch.slice(i, TEXTS_AT_ONCE))


def vectors(counted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counted.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature, one row per task; place -1 counts the texts."""
    found, texts = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for _, data, bounds in _slices(batch):
            found += (counts(data, bounds) > 0).sum(0)
            texts += len(bounds) - 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS), pa.int32()), pa.array(np.append(texts, found), pa.int64())], names=["place", "n"])


def _vectors(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            for part, data, bounds in _slices(batch):
                rows = vectors(counts(data, bounds), idf).astype("<f4")
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "vector"])

    return run


def _cluster(table: pa.Table) -> pa.Table:
    """Spherical k-means of one language's sample, from far apart starts."""
    x = np.stack([np.frombuffer(v, "<f4") for v in sorted(table.column("vector").to_pylist())])
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(CENTROIDS, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centres = x[chosen].copy()
    for _ in range(ITERATIONS):
        near = (x @ centres.T).argmax(1)
        for k in range(len(centres)):
            if (near == k).any():
                mean = x[near == k].mean(0)
                centres[k] = mean / max(np.linalg.norm(mean), 1e-12)
    limit = float(np.quantile((x @ centres.T).max(1), STRAY))
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": [lang] * len(centres), "limit": [limit] * len(centres), "vector": [c.astype("<f4").tobytes() for c in centres]})


def fit(rows: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict:
    """The model: idf, centroids, their languages and limits. Only rows where ``learn``
    holds and text and language are not null are read."""
    train = rows.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).cast("binary").alias(TEXT), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("__h")
    )
    seen = {r[0]: r[1] for r in train.select(TEXT).mapInArrow(_frequencies, "place int, n long").groupBy("place").agg(F.sum("n")).collect()}
    total = seen.get(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([seen.get(i, 0) for i in range(DIMENSIONS)], np.float64))).astype(np.float32) + np.float32(1e-3)
    if not total:
        return {"idf": idf, "languages": [], "limits": np.zeros(0), "centres": np.zeros((0, DIMENSIONS), np.float32)}
    # Of each language about three times the sample by the hash's range, then the lowest.
    sizes = {r[0]: r[1] for r in train.groupBy("lang").count().collect()}
    share = F.lit(1.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 3 * SAMPLE / n))).otherwise(share)
    lowest = F.row_number().over(W.partitionBy("lang").orderBy("__h", F.xxhash64(TEXT)))
    sample = train.filter(F.pmod("__h", F.lit(1 << 20)) < share * (1 << 20)).withColumn("__n", lowest).filter(F.col("__n") <= SAMPLE)
    made = sample.select("lang", TEXT).mapInArrow(_vectors(idf), "lang string, vector binary")
    found = made.groupBy("lang").applyInArrow(_cluster, "lang string, limit double, vector binary").orderBy("lang", "vector").collect()
    return {
        "idf": idf,
        "languages": [r["lang"] for r in found],
        "limits": np.array([r["limit"] for r in found]),
        "centres": np.stack([np.frombuffer(r["vector"], "<f4") for r in found]) if found else np.zeros((0, DIMENSIONS), np.float32),
    }


def predict(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep`` (all but the text by default), lang_pred, score and
    rejected."""
    keep = [c for c in df.columns if c != text] if keep is None else keep
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))

    def run(batches):
        names = np.array([*model["languages"], NO_LANGUAGE], object)
        for batch in batches:
            for part, data, bounds in _slices(batch):
                n = len(bounds) - 1
                near, score = np.full(n, len(names) - 1), np.zeros(n)
                letters = np.asarray(part.column("__letters").to_numpy(zero_copy_only=False), bool)
                if len(names) > 1 and letters.any():
                    cos = vectors(counts(data, bounds), model["idf"]) @ model["centres"].T
                    near = np.where(letters, cos.argmax(1), near)
                    score = np.where(letters, np.clip(cos.max(1), 0, 1), 0).astype(np.float64)
                limits = np.append(model["limits"], -1.0)[near]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(names[near], pa.string()), pa.array(score), pa.array(score < limits)],
                    names=[*keep, "lang_pred", "score", "rejected"],
                )

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double, rejected boolean"])
    return rows.mapInArrow(run, schema)
