"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages: 32 words from every 16th word on, for benchmark items of
up to 32 words, and 64 from every 32nd for longer ones (items above 64 words are cut
themselves, and each of their words is in a cut). A passage is a TF-IDF vector of its lower-cased words without signs at
the ends, weight ``sqrt(count * idf)``: the roots keep an item that a good part of all
documents holds from vanishing beside rare words. Document frequencies count every
document, and no word is left out.

A randomised SVD of the benchmark's passages, two passes of Spark tasks with small
matrices on the driver, gives term factors: a passage's latent vector is the sum of
its terms' factors, worked out once for each 16 words. A document's words count there
once for each 16 words, and its length as if all were different, so the cosine with
an item that follows in the latent space is about the true one or more; at
``CANDIDATE`` and above it is checked word by word. In running text the words around
a short item, or what is left of one, keep the cosine low. So an item is also checked
where a passage has ``PARAPHRASE`` of its words; for that, passages (``HOLDING``) are so
large that one of them holds the item whole. Such a passage has some of the item's
rarest words, so an index from those to the items names the few passages to look at.

The check: the longest common subsequence of words between the item and the passage
with its surroundings, as a share of the item, is at least ``VERBATIM``; or it is at
least ``PARAPHRASE`` and of the item's answer, the words of its last sentence, at
least ``ANSWER`` are there.

A benchmark is taken in blocks of at most ``BLOCK`` passages, a pass over the documents
for each block; that bounds what tasks are sent, and keeps the factors as many as the
passages, so that the retrieval loses nothing against the full cosine.

An item of fewer than ``LEAST`` words is found where exactly these follow each other.

Defined results: null and empty texts hold nothing; items without a word, and null
ones, are left out; equal rows get equal rows; a null key is carried
through; an empty benchmark finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import shuffle_tasks
from corpusprep.llm.hashing import BYTE_CODES, Names, words_in
from corpusprep.llm.repeats import TEXT, text_slices

#: Words of a passage, and from one passage to the next; both in steps of ``STEP``.
SCALES = ((32, 16), (64, 32))
#: The same, where items of up to so many words lie whole in one passage.
HOLDING = ((32, 16, 17), (64, 32, 33), (128, 64, 65))
STEP = 16
BINS = 1 << 17
#: Added to every idf, so that a word in all documents still counts.
LEAST_IDF = 0.2
CANDIDATE = 0.4
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
LEAST = 5
BLOCK = 512
OVERSAMPLING = 8
WINDOWS_AT_ONCE = 4096
BLOCKS_AT_ONCE = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie behind each other, in lower case and
    without signs at the ends (words of signs alone are left out), and their bounds."""
    data = _LOWER[data]
    starts, ends, _ = words_in(data, bounds)
    a, b = starts.copy(), ends.copy()
    odd = np.arange(len(a))
    while len(odd):  # only words that still have a sign at an end
        odd = odd[a[odd] < b[odd]]
        front, back = _SIGN[data[a[odd]]], _SIGN[data[b[odd] - 1]]
        a[odd] += front
        b[odd] = np.maximum(b[odd] - back, a[odd])
        odd = odd[front | back]
    filled = a < b
    a, b = a[filled], b[filled]
    return Names(BYTE_CODES[data])(a, b), np.searchsorted(a, bounds)


def _bins(words: np.ndarray) -> np.ndarray:
    return (words % np.uint64(BINS)).astype(np.int64)


def _frequencies(batches):
    """Documents that hold a word of each bin, a row per task and bin; -1 counts them."""
    found, n = np.zeros(BINS, np.int64), 0
    for batch in batches:
        for _, data, bounds in text_slices(batch):
            words, edges = words_of(data, bounds)
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
            pairs = np.unique(text * BINS + _bins(words))
            found += np.bincount(pairs % BINS, minlength=BINS)
            n += len(bounds) - 1
    filled = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, filled), pa.int32()), pa.array(np.append(n, found[filled]))], names=["bin", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """The root of every bin's idf over all documents."""
    seen = texts.mapInArrow(_frequencies, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BINS)
    at = seen["bin"].to_numpy()
    total = float(seen["n"][at == -1].sum())
    counts[at[at >= 0]] = seen["n"].to_numpy()[at >= 0]
    return np.sqrt(np.log((1 + total) / (1 + counts)) + LEAST_IDF).astype(np.float32)


def weighted(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of one passage and their weights."""
    terms, count = np.unique(words, return_counts=True)
    return terms, np.sqrt(count) * idf[_bins(terms)]


# --- the benchmark --------------------------------------------------------------


class Item:
    """A benchmark item, or a cut of a long one."""

    def __init__(self, key, words: np.ndarray, answer: np.ndarray):
        self.key, self.words, self.answer = key, words, answer
        self.scale = 0 if len(words) <= SCALES[0][0] else 1


_SENTENCE = re.compile(r"[^.!?\n]*[^.!?\s][^.!?\n]*[.!?\s]*$")


def _one(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(raw, np.array([0, len(raw)]))[0]


def items_of(key, text: str) -> list[Item]:
    words = _one(text)
    if not len(words):
        return []
    last = _SENTENCE.search(text)
    answer = np.unique(_one(last.group(0) if last else text))
    size = SCALES[-1][0]
    starts = range(0, max(1, len(words) - size // 2), size)
    cuts = [words[a : a + size] for a in starts]
    if starts[-1] + size < len(words):  # an end of up to half a cut: the last words again, for who holds just these
        cuts += [words[-size:], words[-(size // 2) :]]
    return [Item(key, cut, answer) for cut in cuts]


def _sketch(idf: np.ndarray, width: int):
    """First pass: each passage's sketch, its vector times a random matrix whose rows are
    drawn from the terms."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                terms, weight = weighted(np.frombuffer(row["words"], np.uint64), idf)
                y = sum((w * np.random.default_rng(int(t)).standard_normal(width) for t, w in zip(terms, weight, strict=True)), np.zeros(width))
                yield pa.RecordBatch.from_pydict({"place": [row["place"]], "y": [np.asarray(y, "<f8").tobytes()]})

    return run


def _projected(idf: np.ndarray, basis: np.ndarray):
    """Second pass: the parts of each passage in the basis, by term."""

    def run(batches):
        for batch in batches:
            total: dict[int, np.ndarray] = {}
            for row in batch.to_pylist():
                terms, weight = weighted(np.frombuffer(row["words"], np.uint64), idf)
                for t, w in zip(terms.tolist(), weight, strict=True):
                    total[t] = total.get(t, 0) + w * basis[row["place"]]
            terms = np.array(list(total), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.view(np.int64)), pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())], names=["term", "row"]
            )

    return run


def _summed(table: pa.Table) -> pa.Table:
    total: dict[int, np.ndarray] = {}
    for t, row in zip(table.column("term").to_pylist(), table.column("row").to_pylist(), strict=True):
        total[t] = total.get(t, 0) + np.frombuffer(row, "<f8")
    return pa.table({"term": pa.array(list(total), pa.int64()), "row": pa.array([v.tobytes() for v in total.values()], pa.binary())})


def term_factors(spark, items: list[Item], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of the items, sorted, and a factor for each, by a randomised SVD."""
    width = len(items) + OVERSAMPLING
    tasks = shuffle_tasks(spark)
    rows = spark.createDataFrame([(i, item.words.astype("<u8").tobytes()) for i, item in enumerate(items)], "place long, words binary")
    sketch = rows.mapInArrow(_sketch(idf, width), "place long, y binary").collect()
    y = np.zeros((len(items), width))
    for place, row in sketch:
        y[place] = np.frombuffer(row, "<f8")
    basis, _ = np.linalg.qr(y)
    parts = rows.mapInArrow(_projected(idf, basis), "term long, row binary").withColumn("part", F.pmod("term", F.lit(tasks)))
    found = parts.groupBy("part").applyInArrow(_summed, "term long, row binary").collect()
    if not found:
        return np.zeros(0, np.uint64), np.zeros((0, 1), np.float32)
    terms = np.array([r[0] for r in found], np.int64).view(np.uint64)
    small = np.stack([np.frombuffer(r[1], "<f8") for r in found], 1)  # basis x terms
    _, values, right = np.linalg.svd(small, full_matrices=False)
    kept = values > 1e-9 * values[0]
    order = np.argsort(terms)
    return terms[order], right[kept].T[order].astype(np.float32)


# --- the search -----------------------------------------------------------------


def common_subsequence(one: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    best = np.zeros(len(other) + 1, np.int64)
    for w in one:
        took = np.where(other == w, best[:-1] + 1, 0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], took))
    return int(best[-1])


class Search:
    """Finds items in texts."""

    def __init__(self, items: list[Item], idf: np.ndarray, terms: np.ndarray, factors: np.ndarray):
        self.items, self.idf, self.terms = items, idf, terms
        self.latent = np.zeros((len(items), factors.shape[1]), np.float32)
        for i, item in enumerate(items):
            t, w = weighted(item.words, idf)
            norm = max(float(np.sqrt((w * w).sum())), 1e-9)
            self.latent[i] = w.astype(np.float32) @ factors[np.searchsorted(terms, t)] / norm
        n = np.array([len(item.words) for item in items])
        #: A term's factor times its weight.
        self.weighted = factors * idf[_bins(terms)].astype(np.float64)[:, None]
        #: The places of the items' words among the terms, one past the end behind them.
        self.places = np.full((len(items), n.max(initial=1)), len(terms))
        for i, item in enumerate(items):
            self.places[i, : n[i]] = np.searchsorted(terms, item.words)
        self.present = np.zeros(len(terms) + 1, bool)
        #: (words, stride, items) to compare by their latent vectors
        self.passes = []
        for scale, (size, stride) in enumerate(SCALES):
            own = np.flatnonzero([item.scale == scale and len(item.words) >= LEAST for item in items])
            self.passes.append((size, stride, own))
        #: (words, stride, rarest words of the items as an index: bounds by term, items and their share)
        self.holding = []
        for before, (size, stride, most) in zip((LEAST - 1, *(h[2] for h in HOLDING)), HOLDING, strict=False):
            own = np.flatnonzero((n > before) & (n <= most))
            if len(own):
                self.holding.append((size, stride, *self._rarest(own, n)))
        #: Items of a few words, by the name of their sequence.
        self.short: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero(n < LEAST):
            name = int(Names(items[i].words).every(int(n[i]))[0])
            self.short.setdefault(int(n[i]), {}).setdefault(name, []).append(int(i))

    def _rarest(self, own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Who has ``need`` of an item's n words has at least ``asked`` of its rarest
        n - need + asked. Bounds by term of its entries, one for each item that it is one of
        these of; their places in the order of items; and there, the items and how often they
        hold the term, in shares of what is asked."""
        term, item, share = [], [], []
        for i in own:
            need = int(np.ceil(PARAPHRASE * n[i] - 1e-9))
            asked = max(1, need // 4)
            t, count = np.unique(self.places[i, : n[i]], return_counts=True)
            order = np.argsort(-self.idf[_bins(self.terms[t])], kind="stable")
            enough = int(np.searchsorted(np.cumsum(count[order]), n[i] - need + asked)) + 1
            chosen = order[:enough]
            term.append(t[chosen])
            item.append(np.full(len(chosen), i))
            share.append(count[chosen] / asked)
        term, item, share = np.concatenate(term), np.concatenate(item), np.concatenate(share)
        by_item, by_term = np.lexsort((term, item)), np.lexsort((item, term))
        place_of = np.empty(len(term), np.int64)
        place_of[by_item] = np.arange(len(term))
        return np.searchsorted(term[by_term], np.arange(len(self.terms) + 1)), place_of[by_term], item[by_item], share[by_item]

    def find(self, data: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float]]:
        """(text, item): cosine, common share and answer share of the best passage."""
        words, edges = words_of(data, bounds)
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        if not len(words) or not len(self.terms):
            return found
        weight = self.idf[_bins(words)].astype(np.float64)
        term = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = self.terms[term] == words
        mass = np.concatenate([[0], np.cumsum(weight**2)])
        hits = np.concatenate([[0], np.cumsum(np.where(hit, weight**2, 0))])
        first = np.concatenate([[0], np.cumsum(-(-np.diff(edges) // STEP))])
        text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        block = first[text] + (np.arange(len(words)) - edges[text]) // STEP
        there = np.flatnonzero(hit)
        blocks = self._blocks(block[there], term[there], int(first[-1]))
        lengths = np.diff(edges)

        def passages(size: int, stride: int):
            count = np.maximum(-(-(lengths - stride) // stride), 1) * (lengths > 0)
            text = np.repeat(np.arange(len(count)), count)
            place = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * stride
            lo = edges[:-1][text] + place
            return count, text, place, lo, np.minimum(lo + size, edges[1:][text])

        def latents(size: int, text: np.ndarray, place: np.ndarray) -> np.ndarray:
            begin = first[text] + place // STEP
            end = np.minimum(begin + size // STEP, first[text + 1])
            out = blocks[begin].astype(np.float64)
            for k in range(1, size // STEP):
                own = np.flatnonzero(begin + k < end)
                out[own] += blocks[begin[own] + k]
            return out.astype(np.float32)

        for size, stride, own in self.passes:
            if not len(own):
                continue
            _, text, place, lo, hi = passages(size, stride)
            total = mass[hi] - mass[lo]
            usable = np.flatnonzero((hits[hi] - hits[lo] >= CANDIDATE**2 * total) & (total > 0))
            for start in range(0, len(usable), WINDOWS_AT_ONCE):
                some = usable[start : start + WINDOWS_AT_ONCE]
                cos = latents(size, text[some], place[some]) @ self.latent[own].T / np.sqrt(total[some])[:, None]
                for k, i in zip(*np.nonzero(cos >= CANDIDATE), strict=True):
                    self._check(int(text[some[k]]), int(own[i]), float(min(cos[k, i], 1.0)), words, edges, int(lo[some[k]]), int(hi[some[k]]), found)
        of_text = np.searchsorted(edges, there, "right") - 1
        for size, stride, bounds_of, place_of, items, share in self.holding:
            count, text, place, lo, hi = passages(size, stride)
            before = np.cumsum(count) - count
            many = bounds_of[term[there] + 1] - bounds_of[term[there]]
            rare = np.repeat(np.arange(len(there)), many)
            entry = bounds_of[term[there]][rare] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            # A word lies in the passages that begin in the last ``size`` words.
            pairs = []
            at_word = there[rare] - edges[of_text[rare]]
            for back in range(size // stride):
                k = at_word // stride - back
                inside = (k >= 0) & (k < count[of_text[rare]])
                inside[inside] = at_word[inside] < k[inside] * stride + size
                pairs.append((before[of_text[rare]] + k)[inside] * len(items) + place_of[entry[inside]])
            each = np.unique(np.concatenate(pairs))  # a word counts once in a passage
            if not len(each):
                continue
            window, entry = np.divmod(each, len(items))
            both = window * len(self.items) + items[entry]  # in order, as the entries are
            start = np.flatnonzero(np.diff(both, prepend=-1))
            pair = both[start[np.add.reduceat(share[entry], start) >= 1 - 1e-9]]
            for w, i in self._hold_enough(pair // len(self.items), pair % len(self.items), term, hit, lo, hi):
                total = max(float(mass[hi[w]] - mass[lo[w]]), 1e-9)
                cos = float((latents(size, text[w : w + 1], place[w : w + 1]) @ self.latent[i])[0] / np.sqrt(total))
                self._check(int(text[w]), i, min(cos, 1.0), words, edges, int(lo[w]), int(hi[w]), found)
        for n, names in self.short.items():
            wanted = np.array(sorted(names), np.uint64)
            every = Names(words).every(n) if len(words) >= n else np.zeros(0, np.uint64)
            near = np.minimum(np.searchsorted(wanted, every), len(wanted) - 1)
            for p in np.flatnonzero(wanted[near] == every):
                t = int(np.searchsorted(edges, p, "right")) - 1
                if p + n <= edges[t + 1]:
                    for i in names[int(every[p])]:
                        if np.array_equal(words[p : p + n], self.items[i].words):
                            found[(t, i)] = (1.0, 1.0, 1.0)
        return found

    def _blocks(self, block: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """The latent vectors of the blocks, where a term counts once."""
        pairs = np.unique(block * len(self.terms) + term)
        block, term = np.divmod(pairs, len(self.terms))
        starts = np.searchsorted(block, np.arange(n + 1))
        out = np.zeros((n, self.weighted.shape[1]))
        for low in range(0, n, BLOCKS_AT_ONCE):
            begin, end = starts[low : low + BLOCKS_AT_ONCE + 1][:-1], starts[low + 1 : low + BLOCKS_AT_ONCE + 1]
            # The longest first: those with a k-th term are the first ones.
            order = np.argsort(begin - end, kind="stable")
            begin, count = begin[order], (end - begin)[order]
            vectors = np.zeros((len(order), self.weighted.shape[1]))
            for k in range(int(count[0])):
                m = int(np.searchsorted(-count, -k, "left"))
                vectors[:m] += self.weighted[term[begin[:m] + k]]
            out[low + order] = vectors
        return out

    def _hold_enough(self, windows, items, term, hit, lo, hi) -> Iterator[tuple[int, int]]:
        """Of the pairs, those where the passage has ``PARAPHRASE`` of the item's words."""
        edge = np.flatnonzero(np.diff(windows, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            w, mine = int(windows[a]), items[a:b]
            here = term[lo[w] : hi[w]][hit[lo[w] : hi[w]]]
            places = self.places[mine]
            self.present[here] = True
            held = self.present[places].sum(1) >= PARAPHRASE * (places < len(self.terms)).sum(1)
            self.present[here] = False
            for i in mine[held]:
                yield w, int(i)

    def _check(self, text, i, cos, words, edges, lo, hi, found) -> None:
        item = self.items[i]
        known = found.get((text, i))
        if known and known[1] == 1.0:
            return
        n = len(item.words)
        around = words[max(edges[text], lo - n) : min(edges[text + 1], hi + n)]
        if np.isin(item.words, around).sum() < PARAPHRASE * n:  # no subsequence is longer
            return
        common = common_subsequence(item.words, around) / n
        answer = float(np.isin(item.answer, around).mean()) if len(item.answer) else 0.0
        if common >= VERBATIM or (common >= PARAPHRASE and answer >= ANSWER):
            if known is None or (common, cos) > (known[1], known[0]):
                found[(text, i)] = (cos, common, answer)


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[Item]]:
    """The items in blocks of at most ``BLOCK`` passages, one block on the driver at a
    time if the caller takes one at a time."""
    rows = benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("text is not null")
    block: list[Item] = []
    for row in rows.orderBy("key", "text").toLocalIterator():
        for item in items_of(row["key"], row["text"]):
            block.append(item)
            if len(block) == BLOCK:
                yield block
                block = []
    if block:
        yield block


def _texts(df: DataFrame, text: str, *columns) -> DataFrame:
    return df.select(*columns, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))


def find_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row per document and benchmark item that it holds: key, item_key, cosine,
    common (share of the item's words in the longest common subsequence), answer."""
    spark = df.sparkSession
    kinds = [df.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()]
    schema = f"key {kinds[0]}, item {kinds[1]}, cosine double, common double, answer double"
    idf = inverse_frequencies(_texts(df, text))
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, item_key, item_text):
        terms, factors = term_factors(spark, items, idf)

        def run(batches, search=Search(items, idf, terms, factors)):
            for batch in batches:
                for part, data, bounds in text_slices(batch):
                    found = search.find(data, bounds)
                    pairs = sorted(found)
                    values = np.array([found[p] for p in pairs]).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("key").take(pa.array([t for t, _ in pairs], pa.int64())),
                            pa.array([search.items[i].key for _, i in pairs]).cast(out_kind) if pairs else pa.nulls(0, out_kind),
                            *(pa.array(values[:, c]) for c in range(3)),
                        ],
                        names=["key", "item", "cosine", "common", "answer"],
                    )

        out_kind = _arrow_kind(spark, kinds[1])
        out = out.unionAll(_texts(df, text, F.col(key).alias("key")).mapInArrow(run, schema))
    # The cuts of a long item, and equal documents, are one row.
    best = out.groupBy("key", "item").agg(*(F.max(c).alias(c) for c in ("cosine", "common", "answer")))
    return best.select(F.col("key").alias(key), F.col("item").alias(item_key if item_key != key else "item"), "cosine", "common", "answer")


def _arrow_kind(spark, kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], f"v {kind}").schema).field(0).type


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, with their columns as they were."""
    spark = df.sparkSession
    idf = inverse_frequencies(_texts(df, text))
    names = df.columns
    rows = df.select(*names, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(TEXT))
    for items in _blocks(benchmark, item_key, item_text):
        terms, factors = term_factors(spark, items, idf)

        def run(batches, search=Search(items, idf, terms, factors)):
            for batch in batches:
                for part, data, bounds in text_slices(batch):
                    kept = np.ones(len(bounds) - 1, bool)
                    kept[[t for t, _ in search.find(data, bounds)]] = False
                    yield part.filter(pa.array(kept))

        rows = rows.mapInArrow(run, rows.schema)
    return rows.select(*names)
