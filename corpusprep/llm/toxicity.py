"""Toxicity of texts after their disguise is undone.

Noisy channel: a word meant is written with other signs for letters (leetspeak), with
letters repeated, with signs or blanks between its letters. For a written word (or run of
lone letters, of any length), a lattice holds the readings of each sign; the Viterbi path under a character trigram
model of the corpus and the channel's costs is the word restored. Plain words, letters
only and none three times in a row, are their own reading and skip the lattice.

The restored text is scored by its words, their first four and first five bytes. The
weight of such a feature is how much larger its share of toxic texts is than of others,
as a logarithm and less twice its standard error, so that rare ones weigh little; features below ``LEAST`` are left out.
The weights of a text's features add up, and a logistic curve makes a probability of
the sum. The curve is fitted on sums from which each text's own share was taken out.

What is gathered: trigram counts of every text (one row per task and trigram); and
counts of features over the labelled sample, at most ``TOXIC_SAMPLE`` toxic and
``OTHER_SAMPLE`` other texts, those with the lowest hashes of their keys. The sample's
keys are bounded and so may be sent to all tasks; texts are never shuffled.

Defined results: null and empty texts score like a text without any known feature;
without toxic examples all score 0. Of several labels for one key the highest counts.
Equal rows get equal rows, a null key is carried through, other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.hashing import BYTE_CODES, Names, words_in
from corpusprep.llm.repeats import TEXT, text_slices

TOXIC_SAMPLE = 20_000
OTHER_SAMPLE = 40_000
#: The model holds at most so many features, the heaviest.
FEATURES = 100_000
LEAST = 1.0
SUPPORT = 3
KEPT_WORDS = 200_000

#: What a sign may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "¥": "y",
}
#: A sign that may hide any letter.
ANY = "*#%&_"
#: Readings of written words up to this length are kept for when they come again.
KEPT_LENGTH = 200
#: Characters after which the part of the path that all states share is put aside.
SETTLE = 64
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Natural logarithms of how likely the channel does so.
AS_LEET, AS_ANY, AS_NOISE, REPEATED, GAP = -1.0, -4.0, -1.5, -0.7, -2.5

_EDGES = re.compile(r"^[.,;:?\"'()\[\]{}<>-]+|[.,;:?!\"'()\[\]{}<>-]+$")
_TAIL = re.compile(r"([^\w\s])\1{2,}$|^([^\w\s])\2{2,}")
#: A sign between others that may stand where a blank was.
_JOIN = re.compile(r"\w[^\w\s'\u2019]+\w|[^\W_]_+[^\W_]")
_RUN = re.compile(r"(.)\1\1")


# --- character model ------------------------------------------------------------


def _classes() -> np.ndarray:
    """Six bits per byte: 0 blank and signs, letters, digits as blank, other bytes."""
    table = np.zeros(256, np.int64)
    for c in range(26):
        table[0x41 + c] = table[0x61 + c] = 1 + c
    table[0x80:] = 27 + (np.arange(0x80, 0x100) & 31)
    return table


CLASSES = _classes()


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 18, np.int64)
    for batch in batches:
        for _, data, _ in text_slices(batch):
            c = CLASSES[data]
            total += np.bincount((c[:-2] << 12) | (c[1:-1] << 6) | c[2:], minlength=1 << 18)
    codes = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(total[codes], pa.int64())], names=["code", "n"])


def character_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of a class after two others, from all texts; 64 x 64 x 64."""
    rows = df.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))
    found = rows.mapInArrow(_trigrams, "code int, n long").groupBy("code").agg(F.sum("n")).collect()
    seen = np.zeros(1 << 18)
    for code, n in found:
        seen[code] = n
    seen = seen.reshape(64, 64, 64)
    single = (seen.sum((0, 1)) + 1) / (seen.sum() + 64)
    pairs = (seen.sum(0) + 8 * single) / (seen.sum((0, 2))[:, None] + 8)
    return np.log((seen + 8 * pairs[None]) / (seen.sum(2, keepdims=True) + 8)).astype(np.float32)


@lru_cache(1 << 16)
def _class(c: str) -> int:
    return int(CLASSES[c.encode()[-1]])


class Characters:
    """A character model as numbers that a loop reads fast."""

    def __init__(self, model: np.ndarray):
        self.table = model.ravel().tolist()
        # How many signs for any letter in a row can matter. One read as a letter costs
        # ``AS_NOISE - AS_ANY`` more than one passed over, and all letters of a run can
        # gain no more than the transitions of the two letters behind it.
        most = int(4 * -float(model.min()) / (AS_NOISE - AS_ANY)) + 2
        self.masks = re.compile(f"([{ANY}]{{{most}}})[{ANY}]+")


@lru_cache(1 << 12)
def _readings(sign: str) -> tuple[tuple[str, int, float], ...]:
    """What a sign may stand for: the character, its class, and how likely that is."""
    found = [(r, _class(r), AS_LEET) for r in LEET.get(sign, "")]
    return tuple(found + ([(r, _class(r), AS_ANY) for r in LETTERS] if sign in ANY else []))


def restore(written: str, model: np.ndarray | Characters, spaced: bool = False) -> str:
    """The likeliest word (words, if ``spaced``) behind what is written."""
    model = Characters(model) if isinstance(model, np.ndarray) else model
    table = model.table
    # State: the classes of the last two letters, in 64ths; value: cost and what was read,
    # less what all states have read alike, which is kept in ``settled``.
    states: dict[int, tuple[float, str]] = {0: (0.0, "")}
    settled: list[str] = []
    for place, c in enumerate(model.masks.sub(r"\1", written)):
        if place % SETTLE == SETTLE - 1:
            shared = len(commonprefix([read for _, read in states.values()])) - 1  # the last letter stays in sight
            if shared > 0:
                settled.append(next(iter(states.values()))[1][:shared])
                states = {k: (cost, read[shared:]) for k, (cost, read) in states.items()}
        letter = c.isalpha()
        readings = ((c, _class(c), 0.0),) if letter else _readings(c)
        after: dict[int, tuple[float, str]] = {}
        get = after.get
        for ab, (cost, read) in states.items():
            last = read[-1:]
            if not letter:
                passed = cost + AS_NOISE
                have = get(ab)
                if have is None or have[0] < passed:
                    after[ab] = (passed, read)
            b = ab & 63
            for r, k, channel in readings:
                if last == r:  # one letter written again
                    again = cost + channel + REPEATED
                    have = get(ab)
                    if have is None or have[0] < again:
                        after[ab] = (again, read)
                on = cost + channel + table[ab << 6 | k]
                have = get(b << 6 | k)
                if have is None or have[0] < on:
                    after[b << 6 | k] = (on, read + r)
                if spaced and last and last != " ":
                    apart = cost + channel + GAP + table[ab << 6] + table[b << 12 | k]
                    have = get(k)
                    if have is None or have[0] < apart:
                        after[k] = (apart, read + " " + r)
        states = after
    ends = [(cost + table[ab << 6], read) for ab, (cost, read) in states.items()]
    return "".join(settled) + max(ends)[1] if ends else ""


# --- features -------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
#: Signs at the ends of a word that are not part of it.
_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in ".,;:?!\"'()[]{}<>-"]] = True


def _plain_features(names: Names, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of words of two bytes or more, and of their first four and five bytes if
    they are longer, and which of the words have them."""
    out = []
    for size in (0, 4, 5):
        has = np.flatnonzero((ends - starts > size) if size else (ends - starts >= 2))
        stop = starts[has] + size if size else ends[has]
        out.append((has, names(starts[has], stop) + np.uint64(size)))
    return out


def _features_of(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    starts = ends - np.array([len(w) for w in raw])
    return _plain_features(Names(BYTE_CODES[data]), starts, ends)


def word_features(words: list[str]) -> np.ndarray:
    """The same hashes for words given one by one."""
    return np.concatenate([h for _, h in _features_of(words)])


class Reader:
    """Finds the features of texts, or of them those in ``wanted`` (sorted); keeps the
    readings of words it has met."""

    def __init__(self, model: np.ndarray, wanted: np.ndarray | None = None):
        self.model = Characters(model)
        self.known: dict[bytes, tuple[str, ...]] = {}
        self.wanted = wanted
        if wanted is not None:
            self.maybe = np.zeros(1 << 20, bool)
            self.maybe[wanted & np.uint64((1 << 20) - 1)] = True

    def _chosen(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes are wanted: a look at a bit for all, a search for the few."""
        if self.wanted is None:
            return np.arange(len(hashes))
        few = np.flatnonzero(self.maybe[hashes & np.uint64((1 << 20) - 1)])
        at = np.minimum(np.searchsorted(self.wanted, hashes[few]), len(self.wanted) - 1)
        return few[self.wanted[at] == hashes[few]]

    def _restored(self, written: bytes, spaced: bool = False) -> tuple[str, ...]:
        """The words that what is written may stand for."""
        kept = self.known.get(written)
        if kept is None:
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
            word = written.decode("utf-8", "replace")
            word = word if spaced else _TAIL.sub("", word)
            core = word if spaced else _EDGES.sub("", word)
            found: set[str] = set()
            # Signs at the ends that stand for no letter change nothing.
            for w in {word, core} if any(_readings(c) for c in word if not c.isalpha()) else {core}:
                # A word without a letter is a number or a line of signs, not a disguise.
                if any(c.isalpha() for c in w):
                    if not spaced:
                        found.add(restore(w, self.model))
                    # Signs that stand for no letter of their own may join words.
                    if spaced or _JOIN.search(core):
                        found.update(restore(w, self.model, True).split(" "))
            found.discard("")
            kept = tuple(found)
            if len(written) <= KEPT_LENGTH:
                self.known[written] = kept
        return kept

    def features(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs, each once, sorted."""
        data = _LOWER[data]
        starts, ends, edges = words_in(data, bounds)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
        if not len(starts):
            return text, np.zeros(0, np.uint64)
        lone = self._spaced(data, starts, ends, text)
        a, b = starts.copy(), ends.copy()
        for _ in range(4):  # signs at the ends
            a += (a < b) & _TRIM[data[np.minimum(a, len(data) - 1)]]
            b -= (a < b) & _TRIM[data[b - 1]]
        odd = np.concatenate([[0], np.cumsum(~_LETTER[data])])
        thrice = np.zeros(len(data) + 1, np.int64)
        thrice[3:] = np.cumsum((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])) if len(data) > 2 else 0
        runs = (b - a > 2) & (thrice[b] - thrice[np.minimum(a + 2, b)] > 0)
        noisy = (odd[b] > odd[a]) | runs
        letters = (b - a) > (odd[b] - odd[a])
        plain = np.flatnonzero(~noisy & (a < b))
        names = Names(BYTE_CODES[data])
        texts, hashes = [], []
        for has, h in _plain_features(names, a[plain], b[plain]):
            chosen = self._chosen(h)
            texts.append(text[plain[has[chosen]]])
            hashes.append(h[chosen])
        raw = data.tobytes()
        # Restored words of all these texts get their features at once.
        places: dict[str, int] = {}
        of_text: list[int] = []
        of_word: list[int] = []
        disguised = [(text[i], raw[starts[i] : ends[i]], False) for i in np.flatnonzero(noisy & letters)]
        for t, written, spaced in [*disguised, *((t, written.encode(), True) for t, written in lone)]:
            for word in self._restored(written, spaced):
                of_text.append(t)
                of_word.append(places.setdefault(word, len(places)))
        if places:
            for has, h in _features_of(list(places)):
                at = np.full(len(places), -1)
                at[has] = np.arange(len(has))
                where = at[np.array(of_word)]
                texts.append(np.array(of_text)[where >= 0])
                hashes.append(h[where[where >= 0]])
        texts, hashes = np.concatenate(texts), np.concatenate(hashes)
        chosen = self._chosen(hashes)
        texts, hashes = texts[chosen], hashes[chosen]
        order = np.lexsort((hashes, texts))
        texts, hashes = texts[order], hashes[order]
        new = np.concatenate([[True], (np.diff(texts) != 0) | (hashes[1:] != hashes[:-1])])[: len(texts)]
        return texts[new], hashes[new]

    def _spaced(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray) -> list[tuple[int, str]]:
        """Runs of three or more words of one character, joined."""
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        one = lead[ends] - lead[starts] == 1
        # Runs end with their text.
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (text[1:] != text[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(one))
        out = []
        for i, j in zip(first, last, strict=True):
            if one[i] and j - i > 2:
                out.append((int(text[i]), "".join(bytes(data[starts[k] : ends[k]]).decode("utf-8", "replace") for k in range(i, j))))
        return out


# --- training -------------------------------------------------------------------


def _sum_counts(texts: np.ndarray, hashes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, where = np.unique(hashes, return_inverse=True)
    yes = np.bincount(where, weights=toxic[texts], minlength=len(found)).astype(np.int64)
    return found, yes, np.bincount(where, minlength=len(found)) - yes


def _counts(model: np.ndarray, only: np.ndarray | None):
    def run(batches):
        reader = Reader(model, only)
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                texts, hashes = reader.features(data, bounds)
                found, yes, no = _sum_counts(texts, hashes, np.asarray(part.column("toxic")))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(yes), pa.array(no)], names=["feature", "yes", "no"])

    return run


def _log_ratio(yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float) -> np.ndarray:
    ratio = np.log((yes + 0.1) / (n_yes + 0.2)) - np.log((no + 0.1) / (n_no + 0.2))
    return ratio - 2 * np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5 + n_no / (n_yes + n_no)))


def _weigh(yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float) -> np.ndarray:
    w = _log_ratio(yes, no, n_yes, n_no)
    return np.where((w >= LEAST) & (yes >= SUPPORT), w, 0.0)


def _sums(model: np.ndarray, lexicon: dict):
    """(sum without the text's own share, label) of every labelled text."""

    def run(batches):
        reader = Reader(model, lexicon["feature"])
        feature, yes, no = lexicon["feature"], lexicon["yes"], lexicon["no"]
        n_yes, n_no = lexicon["n_yes"], lexicon["n_no"]
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                toxic = np.asarray(part.column("toxic")).astype(np.int64)
                texts, hashes = reader.features(data, bounds)
                t, at = texts, np.searchsorted(feature, hashes)
                w = _weigh(yes[at] - toxic[t], no[at] - (1 - toxic[t]), n_yes - toxic[t], n_no - (1 - toxic[t]))
                # Without a single feature bincount forgets that weights are not whole numbers.
                total = np.bincount(t, weights=w, minlength=len(toxic)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(total), pa.array(toxic)], names=["sum", "toxic"])

    return run


def _curve(sums: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton steps on log(1 + sum)."""
    x = np.log1p(sums)
    a, b = 1.0, math.log((toxic.sum() + 1) / (len(toxic) - toxic.sum() + 1)) - 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((toxic - p) * x).sum() - 0.01 * a, (toxic - p).sum() - 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
    return a, b


def fit(df: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """The model. ``learn`` is a condition on the key: labels are read only where it
    holds."""
    characters = character_model(df, text)
    known = labels.filter(learn & F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.max(label).cast("double").alias("toxic"))
    order = F.xxhash64("__k")
    chosen = known.filter("toxic = 1").orderBy(order, "__k").limit(TOXIC_SAMPLE).unionAll(known.filter("toxic <> 1").orderBy(order, "__k").limit(OTHER_SAMPLE))
    rows = df.select(F.col(key).alias("__k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))
    rows = rows.join(F.broadcast(chosen), "__k").select(TEXT, "toxic")
    totals = {int(r[0]): r[1] for r in rows.groupBy("toxic").count().collect()}
    n_yes, n_no = totals.get(1, 0), totals.get(0, 0)
    model = {"characters": characters, "feature": np.zeros(0, np.uint64), "weight": np.zeros(0), "curve": (1.0, -30.0)}
    if not n_yes:
        return model
    schema = "feature long, yes long, no long"
    total = lambda counted: counted.groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    # First what toxic texts share, then how often others have that; all of it is
    # weighed before the heaviest are taken. The sample of toxic texts bounds it.
    shared = total(rows.filter("toxic = 1").mapInArrow(_counts(characters, None), schema)).filter(F.col("yes") >= SUPPORT)
    only = np.sort(shared.select("feature").toPandas()["feature"].to_numpy(np.int64).view(np.uint64))
    if not len(only):
        return model
    counted = total(rows.mapInArrow(_counts(characters, only), schema)).toPandas()
    feature = counted["feature"].to_numpy(np.int64).view(np.uint64)
    yes, no = counted["yes"].to_numpy(np.int64), counted["no"].to_numpy(np.int64)
    weight = _weigh(yes, no, n_yes, n_no)
    heavy = np.lexsort((feature, -weight))[:FEATURES]
    heavy = heavy[weight[heavy] > 0]
    heavy = heavy[np.argsort(feature[heavy])]
    if not len(heavy):
        return model
    lexicon = {"feature": feature[heavy], "yes": yes[heavy], "no": no[heavy], "n_yes": n_yes, "n_no": n_no}
    pairs = rows.mapInArrow(_sums(characters, lexicon), "sum double, toxic long").toPandas()
    return model | {"feature": feature[heavy], "weight": weight[heavy], "curve": _curve(pairs["sum"].to_numpy(), pairs["toxic"].to_numpy(float))}


def score(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: the columns ``keep`` (all but the text by default), n_features (known
    toxic features of the restored text) and score."""
    keep = [c for c in df.columns if c != text] if keep is None else keep
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*keep, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))

    def run(batches):
        reader = Reader(model["characters"], model["feature"] if len(model["feature"]) else None)
        feature, weight, (a, b) = model["feature"], model["weight"], model["curve"]
        for batch in batches:
            for part, data, bounds in text_slices(batch):
                n = len(bounds) - 1
                total, found = np.zeros(n), np.zeros(n, np.int64)
                if len(feature):
                    texts, hashes = reader.features(data, bounds)
                    total = np.bincount(texts, weights=weight[np.searchsorted(feature, hashes)], minlength=n).astype(np.float64)
                    found = np.bincount(texts, minlength=n)
                p = 1 / (1 + np.exp(-np.clip(a * np.log1p(total) + b, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found.astype(np.int64)), pa.array(p)], names=[*keep, "n_features", "score"])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_features long, score double"]))
