"""Language vectors against a plain count, predictions against plain cosines, short texts in slices."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from corpusprep.llm import language_id as lid


def plain_counts(text):
    row = [0] * lid.DIMENSIONS
    raw = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    raw = [32, *raw, 32]
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        if (a, b, c) != (32, 32, 32):
            row[(((a << 16 | b << 8 | c) * 0x9E3779B1) % (1 << 32)) >> 20] += 1
    return row


def some_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeé ü.1\nXYZ") for _ in range(r.choice([0, 1, 2, 5, 80]))) for _ in range(n)]


def test_counts_equal_plain_ones():
    raw = [t.encode() for t in some_texts(1, 60)]
    data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    assert lid.counts(data, bounds).tolist() == [plain_counts(x.decode()) for x in raw]


def test_predictions_equal_plain_cosines(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = lid.fit(docs, F.col("doc_id") % 4 != 2)
    rows = {r["doc_id"]: r for r in lid.predict(docs, model).collect()}
    for key, text in docs.filter("doc_id < 60").select("doc_id", "text").collect():
        v = [math.log1p(c) * float(w) for c, w in zip(plain_counts(text), model["idf"], strict=True)]
        norm = math.sqrt(sum(x * x for x in v)) or 1.0
        cos = [sum(x * float(y) for x, y in zip(v, c, strict=True)) / norm for c in model["centres"]]
        best = max(range(len(cos)), key=cos.__getitem__)
        assert rows[key]["lang_pred"] == model["languages"][best]
        assert abs(rows[key]["score"] - min(max(cos[best], 0), 1)) < 1e-4
        assert rows[key]["rejected"] == (rows[key]["score"] < model["limits"][best])


def test_many_short_texts_are_held_in_slices(monkeypatch):
    import pyarrow as pa

    sizes = []
    plain = lid.counts
    monkeypatch.setattr(lid, "counts", lambda data, bounds: sizes.append(len(bounds) - 1) or plain(data, bounds))
    batch = pa.RecordBatch.from_pydict({lid.TEXT: pa.array([b"ab cd"] * 3000, pa.binary())})
    assert sum(b.num_rows for b in lid._frequencies(iter([batch]))) == lid.DIMENSIONS + 1
    assert sum(sizes) == 3000 and max(sizes) <= lid.TEXTS_AT_ONCE

