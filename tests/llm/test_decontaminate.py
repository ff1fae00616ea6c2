"""The search for partly kept items against a look at every passage, and items of a few words."""

import random

import numpy as np
import pytest

from corpusprep.llm import decontaminate as d


def search_of(texts):
    items = [item for i, t in enumerate(texts) for item in d.items_of(i, t)]
    terms = np.unique(np.concatenate([item.words for item in items]))
    idf = np.random.default_rng(3).uniform(0.5, 3, d.BINS).astype(np.float32)
    # Without factors every cosine is 0, and what is found is found by words.
    return d.Search(items, idf, terms, np.zeros((len(terms), 1), np.float32))


def every_passage(search, words, edges):
    found = {}
    n = np.array([len(item.words) for item in search.items])
    for before, (size, stride, most) in zip((d.LEAST - 1, *(h[2] for h in d.HOLDING)), d.HOLDING, strict=False):
        for t in range(len(edges) - 1):
            length = edges[t + 1] - edges[t]
            for place in range(0, max(1, -(-(length - stride) // stride)) * stride, stride) if length else ():
                lo, hi = edges[t] + place, min(edges[t] + place + size, edges[t + 1])
                for i in np.flatnonzero((n > before) & (n <= most)):
                    if np.isin(search.items[i].words, words[lo:hi]).sum() >= d.PARAPHRASE * n[i]:
                        search._check(t, int(i), 0.0, words, edges, int(lo), int(hi), found)
    return found


@pytest.mark.parametrize("seed", range(12))
def test_partly_kept_items_against_every_passage(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(r.choice([30, 120, 900]))]
    say = lambda k: [r.choice(vocabulary) for _ in range(k)]
    items = [say(r.choice([5, 6, 8, 17, 18, 33, 40, 64, 65, 100, 200])) for _ in range(12)]
    texts = []
    for _ in range(12):
        text = say(r.randint(0, 80))
        for item in r.sample(items, 2):
            kept = [w for w in item if r.random() < r.choice([0.6, 0.8, 1.0])]
            text += kept + say(r.randint(0, 60))
        texts.append(" ".join(text))
    texts += ["", "one", " ".join(items[0])]
    search = search_of([" ".join(i) + "." for i in items])
    raw = [t.encode() for t in texts]
    data, bounds = np.frombuffer(b" ".join(raw) + b" ", np.uint8), np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    found = search.find(data, bounds)
    words, edges = d.words_of(data, bounds)
    want = every_passage(search, words, edges)
    assert {k: v[1:] for k, v in found.items()} == {k: v[1:] for k, v in want.items()} and want


def test_items_of_a_few_words_are_found_as_they_are():
    search = search_of(["Tic tac.", "one two three four", "solo", "an item of some more words than that"])
    raw = [b"he said: TIC, tac!", b"tic", b"tac", b"tac tic", b"zero one two three (four) five", b"one two four three", b"he plays solo", b"solos"]
    data, bounds = np.frombuffer(b" ".join(raw) + b" ", np.uint8), np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])])
    assert set(search.find(data, bounds)) == {(0, 0), (4, 1), (6, 2)}


def test_vectors_of_blocks_against_plain_sums(monkeypatch):
    """One row per block of words, not one per word, each the sum of its different terms."""
    monkeypatch.setattr(d, "BLOCKS_AT_ONCE", 4)
    rng = np.random.default_rng(5)
    search = search_of([" ".join(f"w{i}" for i in range(40))])
    search.weighted = rng.standard_normal((len(search.terms), 7))
    block = np.sort(rng.choice([0, 1, 2, 5, 8, 9, 12], 90))
    term = rng.integers(0, len(search.terms), 90)
    plain = np.array([search.weighted[np.unique(term[block == b])].sum(0) for b in range(13)])
    assert np.allclose(search._blocks(block, term, 13), plain, atol=1e-12)
    assert not search._blocks(block[:0], term[:0], 3).any()
