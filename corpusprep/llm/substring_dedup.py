"""Repeated word windows by recompression.

A text is a row of words. Rounds shorten it: equal neighbours become one symbol for
their run, then a symbol of one half of the alphabet followed by one of the other
half become one symbol for the pair. A symbol's name is a hash of what it stands for,
and the halves are drawn from names, so the names are global: every task gives equal
strings the same symbols, and a round needs no shuffle. What a symbol does not see
cannot change it: inside equal substrings the same symbols arise, but for those near
the ends, whose neighbours differ.

Each border between symbols remembers the words on which its survival rested. For a
window of 20 words the borders that rest on words of the window alone are the same in
every equal window. The highest round's are taken, of those the one with the lowest
name, and the name of the words that it rests on is what equal windows share. Spark
brings equal names together; what follows verifies them down to single windows (see
``repeats``).

Defined results: null text has no words; texts below 20 words keep everything; of
equal rows the first in the order of (key, content) counts as earlier, null keys come
first; only the columns named are read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm import repeats
from corpusprep.llm.hashing import Names, mix, word_codes, words_in
from corpusprep.llm.suffix_dedup import inside, runs_of

WINDOW = 20
#: After two rounds a border rests on some 9 words: few enough that a window of 20
#: holds several to choose from, and enough that unrelated texts rarely share them.
ROUNDS = 2


def _units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, edges = words_in(data, bounds)
    return word_codes(data, starts, ends), edges


def borders_by_round(codes: np.ndarray, bounds: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each half round: the borders that are left, and the first word and the end
    of the words that they rest on. The ends of texts rest on words beyond them, which
    no window has."""
    at = np.arange(len(codes) + 1)
    edge = np.zeros(len(at), bool)
    edge[bounds] = True
    left, right, names = at.copy(), at.copy(), codes
    out = [(at, left, right)]

    def keep(stays: np.ndarray) -> None:
        """Borders that stay now also rest on their neighbours' words."""
        nonlocal at, edge, left, right
        seen_left = np.concatenate([left[:1], left[:-1]])  # both rise from border to border
        seen_right = np.concatenate([right[1:], right[-1:]])
        seen_left[edge], seen_right[edge] = at[edge] - 1, at[edge] + 1
        at, edge, left, right = at[stays], edge[stays], seen_left[stays], seen_right[stays]
        out.append((at, left, right))

    for r in range(rounds):
        # Runs: a border goes where both sides are the same symbol of one text.
        stays = np.concatenate([[True], names[1:] != names[:-1], [True]]) | edge
        heads = np.flatnonzero(stays[:-1])
        sizes = np.diff(np.append(heads, len(names))).astype(np.uint64)
        with np.errstate(over="ignore"):
            names = np.where(sizes > 1, mix(names[heads] + sizes * np.uint64(0x9E3779B97F4A7C15)), names[heads])
        keep(stays)
        # Pairs: a border goes between a symbol of the first half and one of the second.
        second = (mix(names + np.uint64(r + 1)) >> np.uint64(40)) & np.uint64(1) == 1
        joined = ~second[:-1] & second[1:]
        stays = np.concatenate([[True], ~joined, [True]]) | edge
        heads = np.flatnonzero(stays[:-1])
        pair = np.diff(np.append(heads, len(names))) == 2
        with np.errstate(over="ignore"):
            follower = names[np.minimum(heads + 1, len(names) - 1)]
            names = np.where(pair, mix(names[heads] * np.uint64(3) + mix(follower)), names[heads])
        keep(stays)
        if not ((right - left) <= window).any():
            break
    return out


def _groups(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    windows = inside(bounds, WINDOW)
    if not len(windows):
        return np.zeros(0, np.uint64), windows, windows
    names = Names(codes)
    place = np.full(len(windows), -1, np.int64)  # a number for the border and its round
    low, high = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    open_ = np.arange(len(windows))
    for r, (at, left, right) in reversed(list(enumerate(borders_by_round(codes, bounds)))):
        if not len(open_):
            break
        # Both ends rise from border to border: a window holds those from a to b.
        i = windows[open_]
        a = np.searchsorted(left, i, "left")
        b = np.searchsorted(right, i + WINDOW, "right")
        found = a < b
        a, b, hit = a[found], b[found], open_[found]
        usable = (right - left <= WINDOW) & (left >= 0) & (right <= len(codes))
        name = np.zeros(len(at), np.uint64)
        name[usable] = names(left[usable], right[usable])
        best, best_name = a.copy(), name[a]
        for step in range(1, int((b - a).max(initial=1))):
            other = np.minimum(a + step, b - 1)
            better = name[other] < best_name
            best[better], best_name[better] = other[better], name[other][better]
        place[hit] = best + r * (len(codes) + 1)
        low[hit], high[hit] = left[best], right[best]
        open_ = open_[~found]
    first, last = runs_of(windows, place)
    return names(low[first], high[first]), windows[first], windows[last]


METHOD = repeats.Method(WINDOW, _units, _groups, lambda codes: Names(codes, 1), lambda codes: Names(codes, 0))


def _cut(text: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
    words = text.split()  # bytes split at the space and U+0009 to U+000D
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``df``: the columns ``keep`` (by default the key), n_words, n_removed
    and the ``kept`` words, joined by one space, as UTF-8."""
    keep = [key] if keep is None else keep
    texts = repeats.numbered(df, key, text, keep)
    return repeats.apply_spans(texts, repeats.repeated_spans(texts, METHOD), _cut, "n_words long, n_removed long, kept binary", keep)


def digest(result: DataFrame, key: str = "doc_id") -> DataFrame:
    return result.select(key, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def digest_sql(table: str = "documents", size: int = WINDOW) -> str:
    """The same in SQL for DuckDB, by numbering every window."""
    return f"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from {table}),
u as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from t),
v as (select doc_id, i, w[i] as word, case when i + {size - 1} <= len(w) then md5(array_to_string(w[i:i + {size - 1}], ' ')) end as s from u),
x as (select doc_id, i, word, s is not null and row_number() over (partition by s order by doc_id, i) > 1 as later from v),
y as (select doc_id, i, word, max(later) over (partition by doc_id order by i rows between {size - 1} preceding and current row) as gone from x),
z as (select doc_id, count(*) as n, count(*) filter (gone) as g, string_agg(word, ' ' order by i) filter (not gone) as kept from y group by doc_id)
select doc_id, coalesce(n, 0) as n_words, coalesce(g, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from t left join z using (doc_id)"""
