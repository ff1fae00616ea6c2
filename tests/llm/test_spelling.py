"""Spelling variants against all pairs of small vocabularies."""

import random
import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import spelling

SCHEMA = "doc_id long, text string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words, times=10):
    """form, root, n, n_near, form_n for every word."""
    forms, near = {}, {}
    for w, n in words.items():
        found = [v for v in words if one_edit(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        near[w] = len(found)
        forms[w] = best if best and words[best] >= times * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, near[w], words[forms[w]] if forms[w] else None)
    return out


def groups(spark, words, times=10):
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variant_groups(df, times).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    r = random.Random(seed)
    words = set()
    while len(words) < 250:  # few letters, so that runs and neighbours abound
        w = "".join(r.choice("aabé") for _ in range(r.randint(1, 8)))
        words.add(w)
    counts = {w: r.choice([1, 1, 2, 9, 10, 20, 100, 1000, 10_000]) for w in sorted(words)}
    assert groups(spark, counts) == plain(counts)


def test_long_words_and_prefixes_around_the_limit(spark, monkeypatch):
    r = random.Random(7)
    counts = {}
    for size in (62, 63, 64, 65, 66, 300, 5000):
        w = "".join(r.choice("ab") for _ in range(size))
        at = size // 2
        for i, v in enumerate([w, w[:at] + "c" + w[at:], w[:at] + "x" + w[at + 1 :], w + w[-1], w[1:], "é" + w]):
            counts[v] = 10 ** (i % 4)
    counts["long" * 100_000] = 5
    counts["long" * 100_000 + "x"] = 50
    assert groups(spark, counts) == plain(counts)


def test_chains_end_at_their_root(spark):
    words = {"aaaaaaa" + "b" * i: 10**i for i in range(8)}
    assert groups(spark, words) == plain(words)
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([("a", 1)], "word string, n long"), 1)


def words_of(docs, every):
    counts = Counter()
    for key, text in docs:
        for run in brute.re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_documents_with_edges(spark):
    r = random.Random(3)
    stems = ["Gewöhnlich", "ÄRGERLICH", "straightforward", "sixsix", "sevenup", "x×÷ÿÀabc", "İstanbul", "naïveté's"]
    docs = [(i % 40, " ".join(r.choice(stems) for _ in range(30))) for i in range(60)]
    docs += [(None, "Gewöhnlich Gewöhnlich"), (None, None), (1, ""), (2, "\u2028" * 9), (3, "word " * 40_000), (3, "sevenup " * 40_000), (4, "q" * 30_000), (5, "q" * 30_000)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("id", F.lit(0))
    got = {x["word"]: (x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in spelling.spelling_variants(df, edit_every=5).collect()}
    assert got == plain(words_of(docs, 5)) and got
    assert spelling.spelling_variants(df.limit(0), edit_every=5).collect() == []


def test_rows_grow_with_the_words_not_with_pairs(spark):
    """A group of one character more or less in the same place: rows stay a few per word."""
    letters = [chr(c) for c in range(0xC0, 0x100)] + [chr(c) for c in range(97, 123)]
    words = spark.createDataFrame([(i, f"common{c}word", i + 1) for i, c in enumerate(letters)], "id long, word string, n long")
    assert spelling.rotations(words).count() == len(letters) * (11 + 12)
    assert {r["n_near"] for r in spelling.neighbours(words).collect()} == {len(letters) - 1}
