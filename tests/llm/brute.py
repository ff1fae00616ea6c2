"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def covered(rows: list[tuple], size: int) -> list[list[bool]]:
    """For rows in their order, the units under a window that was there before."""
    seen, out = set(), []
    for row in rows:
        gone = [False] * len(row)
        for i in range(len(row) - size + 1):
            window = tuple(row[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        out.append(gone)
    return out


def word_dedup(docs: list[tuple], size: int = 20) -> dict:
    rows = [words(t) for _, t in docs]
    out = {}
    for (key, _), row, gone in zip(docs, rows, covered(rows, size), strict=True):
        kept = " ".join(w for w, g in zip(row, gone, strict=True) if not g)
        out[key] = (len(row), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_dedup(docs: list[tuple], size: int = 100) -> dict:
    rows = [(t or "").encode() for _, t in docs]
    out = {}
    for (key, _), row, gone in zip(docs, rows, covered(rows, size), strict=True):
        kept = bytes(b for b, g in zip(row, gone, strict=True) if not g)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        out[key] = (len(row), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def shingles(text: str | None, size: int = 3) -> set:
    low = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(low) < size:
        return {tuple(low)} if low else set()
    return {tuple(low[i : i + size]) for i in range(len(low) - size + 1)}


def jaccard_classes(docs: list[tuple], threshold: int = 90, shingle: int = 3) -> dict:
    sets = [shingles(t, shingle) for _, t in docs]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    smallest: dict[int, int] = {}
    for i, (key, _) in enumerate(docs):
        smallest[find(i)] = min(key, smallest.get(find(i), key))
    return {key: (len(sets[i]), smallest[find(i)]) for i, (key, _) in enumerate(docs)}


def best_fit_decreasing(items: list[int], length: int) -> list[int]:
    """Room left in every bin."""
    bins: list[int] = []
    for size in sorted(items, reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= size]
        if fit:
            bins[min(fit, key=lambda b: bins[b])] -= size
        else:
            bins.append(length - size)
    return sorted(bins)


def corpus(seed: int, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, blanks and nulls."""
    r = random.Random(seed)
    vocabulary = [f"{r.choice('bcdfgh')}{r.choice('aeiou')}{i}" for i in range(r.choice([8, 60, 600]))]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passages = [text(r.randint(15, 70)) for _ in range(4)]
    out: list[str | None] = []
    while len(out) < n:
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.5:
            row = words(r.choice(out[:5] if r.random() < 0.6 else out))
            for _ in range(r.choice([1, 1, 2, 3])):
                if row:
                    at = r.randrange(len(row))
                    row[at : at + r.choice([0, 1, 1])] = [r.choice(vocabulary)]
            out.append(" ".join(row))
        elif kind < 0.58:
            out.append(r.choice([None, "", " \t\n", "a", "a B", "é" * 90, "x" * 400]))
        else:
            out.append("  ".join([text(r.randint(0, 40)), r.choice(passages), text(r.choice([1, 30, 200])), r.choice(passages)]))
    return list(enumerate(out))
