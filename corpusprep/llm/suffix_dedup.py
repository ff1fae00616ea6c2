"""Repeated byte strings of 100 bytes, without a rank for every byte.

The method asked for is prefix doubling: rounds that sort pairs of ranks at growing
offsets. Ranking every position shuffles many times the text, so it is swapped for
sampling: of every 100-byte window the position whose next ``FIRST`` bytes hash lowest
stands for it, so that equal windows have equal samples, one in about 35 bytes. Spark
deals the samples by a hash of these bytes and sorts them; unique ones are done. Of those
that are left, each is compared by a hash of all that its windows cover: a later one of
equal ones repeats as a whole, and a name with one such hash only is done too. For what
is left now, the edges of repeats, every window is named by its two halves of 50 bytes,
and all but the earliest of equal ones repeat. There is no loop over lengths.

Defined results: null text is empty; texts below 100 bytes keep everything; of equal
rows the first in the order of (key, content) counts as earlier, null keys come
first; only the columns named are read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm import repeats
from corpusprep.llm.hashing import BYTE_CODES, Names

WINDOW = 100
FIRST = 32


def _units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_CODES[data], bounds


def window_minima(keys: np.ndarray, size: int) -> np.ndarray:
    """For each start, the place of the lowest of the next ``size`` keys; of equal ones
    the last. Only the keys' upper halves count."""
    n = len(keys)
    low = (keys & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, 0, -1, dtype=np.uint64)
    width = 1
    while 2 * width <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < size:
        low = np.minimum(low[: n - size + 1], low[size - width :])
    return n - (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """The windows that lie inside one text."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    return np.arange(counts.sum()) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)


def runs_of(windows: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last entries of runs of windows next to each other with one place."""
    if not len(windows):
        return windows, windows
    new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(windows) != 1)])
    first = np.flatnonzero(new)
    return first, np.append(first[1:] - 1, len(windows) - 1)


def _groups(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    windows = inside(bounds, WINDOW)
    if not len(windows):
        return np.zeros(0, np.uint64), windows, windows
    ranks = Names(codes).every(FIRST)
    place = window_minima(ranks, WINDOW - FIRST + 1)[windows]
    first, last = runs_of(windows, place)
    return ranks[place[first]], windows[first], windows[last]


METHOD = repeats.Method(WINDOW, _units, _groups, lambda codes: Names(codes, 1), lambda codes: Names(codes, 0))


def _cut(text: bytes, spans: np.ndarray) -> tuple[int, int, int, bytes]:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), b"".join(kept)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``df``: the columns ``keep`` (by default the key), n_bytes, n_removed,
    n_spans and the bytes ``kept``."""
    keep = [key] if keep is None else keep
    texts = repeats.numbered(df, key, text, keep)
    return repeats.apply_spans(texts, repeats.repeated_spans(texts, METHOD), _cut, "n_bytes long, n_removed long, n_spans long, kept binary", keep)


def _left(text: bytes, spans: np.ndarray) -> tuple[int, str]:
    _, removed, _, kept = _cut(text, spans)
    return removed, kept.decode("utf-8", "ignore")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with repeated strings cut from its texts. Bytes of a character that a cut
    left in part go too; a text that was cut and has only blanks left goes as a row.
    Null stays null."""
    other = [c for c in df.columns if c != text]
    rows = df.withColumn("__null", F.col(text).isNull())
    texts = repeats.numbered(rows, key, text, [*other, "__null"])
    cut = repeats.apply_spans(texts, repeats.repeated_spans(texts, METHOD), _left, "__removed long, __left string", [*other, "__null"])
    blank = F.col("__left").rlike(r"^[\x20\x09-\x0D]*$")
    return cut.filter((F.col("__removed") == 0) | ~blank).withColumn(text, F.when(~F.col("__null"), F.col("__left"))).select(*df.columns)


def digest(result: DataFrame, key: str = "doc_id") -> DataFrame:
    return result.select(key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def digest_sql(table: str = "documents", size: int = WINDOW) -> str:
    """The same in SQL for DuckDB, by numbering every byte's window."""
    return f"""
with t as (select doc_id, hex(encode(coalesce(text, ''))) as h from {table}),
u as (select doc_id, h, unnest(range(len(h) // 2)) as i from t),
v as (select doc_id, i, substr(h, 2 * i + 1, 2) as b, case when 2 * (i + {size}) <= len(h) then md5(substr(h, 2 * i + 1, {2 * size})) end as s from u),
x as (select doc_id, i, b, s is not null and row_number() over (partition by s order by doc_id, i) > 1 as later from v),
y as (select doc_id, i, b, max(later) over (partition by doc_id order by i rows between {size - 1} preceding and current row) as gone from x),
r as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as begins from y),
z as (select doc_id, count(*) as n, count(*) filter (gone) as g, count(*) filter (begins) as runs, string_agg(b, '' order by i) filter (not gone) as kept from r group by doc_id)
select doc_id, coalesce(n, 0) as n_bytes, coalesce(g, 0) as n_removed, coalesce(runs, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from t left join z using (doc_id)"""
