"""Nulls, empty and long texts, ties, repeated rows, empty tables, names that clash."""

import hashlib
import random
import sys
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusprep.llm import (
    decontaminate,
    graph,
    jaccard,
    language_id,
    packing,
    quality,
    repeats,
    sharding,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)
from corpusprep.llm.queries import TOKENIZER, URL_RULES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "n_words long, kept string, score double, node long, key string, rows binary, part int, shard int, length long"
LONG_TEXT = "word " * 60_000 + "end"


def table(spark, docs, clash=False):
    rows = [(k, t, "en", "src", None if t is None else len(t)) for k, t in docs]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split(" ")
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


EDGES = [(1, None), (2, ""), (3, " \t\n\x0b "), (None, "null key"), (None, "null key"), (None, "other null key"), (7, "same row"), (7, "same row"), (7, "same key"), (8, LONG_TEXT), (9, "x" * 5000), (10, "é\u2028ü\x00 \x1c z")]

OPERATORS = {
    "rules": lambda df: quality.apply_rules(df),
    "good": lambda df: quality.good_documents(df),
    "words": lambda df: substring_dedup.digest(substring_dedup.remove_repeats(df)),
    "bytes": lambda df: suffix_dedup.digest(suffix_dedup.remove_repeats(df)),
    "without": lambda df: suffix_dedup.without_repeats(df),
    "classes": lambda df: jaccard.jaccard_classes(df),
    "one": lambda df: jaccard.one_of_each(df),
    "shards": lambda df: sharding.assign_shards(df, sharding.even_tree(16), sharding.even_tree(17)),
    "packed": lambda df: packing.pack_documents(df, *TOKENIZER),
    "language": lambda df: language_id.predict(df, language_id.fit(df, F.lit(True)), keep=["doc_id"]),
    "toxic": lambda df: toxicity.score(df, toxicity.fit(df, df.select("doc_id", F.lit(1).alias("toxic")), F.lit(True)), keep=["doc_id"]),
    "leaks": lambda df: decontaminate.find_leaks(df, df.select(F.col("doc_id").alias("item_id"), "text")),
    "leakless": lambda df: decontaminate.without_leaks(df, df.limit(0).select(F.col("doc_id").alias("item_id"), "text")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edge_rows(spark, name):
    df = table(spark, EDGES, clash=True)
    rows = OPERATORS[name](df).collect()
    if name in ("rules", "words", "bytes", "classes", "shards", "language", "toxic"):
        assert Counter(r["doc_id"] for r in rows) == Counter(k for k, _ in EDGES)
    if name in ("good", "without", "one", "leakless"):
        assert list(rows[0].asDict()) == df.columns if rows else True


def test_packing_calls_the_tokenizer_as_it_was_loaded(spark):
    """The string of the special token is that token, in texts of steady and other characters."""
    from tokenizers import Tokenizer

    texts = ["x <|endoftext|> y", "<|endoftext|><|endoftext|>", "日 <|endoftext|>", "<|endoftext|", *(chr(c) * 3 + " " + chr(c + 7) for c in range(0x20, 0x11000, 97) if not 0xD7F0 <= c <= 0xE000)]
    as_loaded = Tokenizer.from_file(TOKENIZER[0])
    want = [e.ids for e in as_loaded.encode_batch(texts, add_special_tokens=False)]
    assert 50256 in want[0]
    assert packing.encoder(*TOKENIZER)(texts) == want == packing.encoder(TOKENIZER[0], None)(texts)
    df = table(spark, list(enumerate(texts)))
    assert {r["doc_id"]: r["length"] for r in packing.pieces(df, *TOKENIZER).collect()} == {i: len(w) + 1 for i, w in enumerate(want)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](table(spark, [])).collect() == []


def test_results_on_edge_rows(spark):
    df = table(spark, EDGES)
    by_key = lambda rows: {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 7)}
    words = by_key(OPERATORS["words"](df).collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert [words[k]["kept_sha256"] for k in (1, 2, 3)] == [empty] * 3
    assert (words[8]["n_words"], words[8]["n_removed"]) == (60_001, 59_999)
    by = by_key(OPERATORS["bytes"](df).collect())
    assert [by[k]["n_bytes"] for k in (1, 2, 3, 9)] == [0, 0, 5, 5000] and by[9]["n_removed"] == 4999 and by[9]["n_spans"] == 1
    classes = OPERATORS["classes"](df).collect()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in classes if r["doc_id"] in (1, 2, 3)} == {(1, 1, 0), (2, 2, 0), (3, 3, 0)}
    # A repeated key: one row of each of its sets' classes; empty sets all stay.
    assert Counter(r["doc_id"] for r in OPERATORS["one"](df).collect())[7] == 2
    language = {r["doc_id"]: r["lang_pred"] for r in OPERATORS["language"](df).collect()}
    assert [language[k] for k in (1, 2, 3, 8)] == ["und", "und", "und", "en"]
    assert {r["kept"] for r in OPERATORS["rules"](df).collect()} == {False}


@pytest.mark.parametrize("seed", range(3))
def test_repeats_against_brute_force(spark, seed):
    docs = brute.corpus(seed)
    df = table(spark, docs).repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in OPERATORS["words"](df).collect()}
    assert got == brute.word_dedup(docs)
    want = {k: v[:4] for k, v in brute.byte_dedup(docs).items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in OPERATORS["bytes"](df).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(200))
def test_groups_find_every_repeat(seed, monkeypatch):
    """The jobs of ``repeats`` one after the other, without Spark, with low limits."""
    import pyarrow as pa
    import pyarrow.compute as pc

    monkeypatch.setattr(repeats, "LONG", 300)
    monkeypatch.setattr(repeats, "KINDS", 2)
    monkeypatch.setattr(repeats, "GROUPS_AT_ONCE", 40)
    texts = [(t or "").encode() for _, t in brute.corpus(seed, 14)]
    n, tasks = len(texts), 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int32()), pa.array(texts, pa.binary())], names=[repeats.KEY, repeats.SEQ, repeats.TEXT])

    def parts(batches):
        whole = pa.Table.from_batches(batches)
        return {p: whole.filter(pc.equal(whole[repeats.PART], p)) for p in set(whole[repeats.PART].to_pylist())}

    for method, units in ((substring_dedup.METHOD, bytes.split), (suffix_dedup.METHOD, list)):
        sent = list(repeats._find_groups(method, tasks)(iter([batch])))
        compared = [b for t in parts(sent).values() for b in repeats._compare_groups(method.size, tasks)(t).to_batches()] if sent else []
        packs = parts(list(repeats._pack_texts(tasks)(iter([batch]))))
        windows = []
        for p, t in (parts(compared) if compared else {}).items():
            asks = t.filter(pc.equal(t["kind"], repeats.ASKS))
            if p in packs:
                windows += repeats._name_windows(method, tasks)(packs[p], asks).to_batches()
        more = [b for t in parts(windows).values() for b in repeats._compare_windows(method.size, tasks)(t).to_batches()] if windows else []
        blobs = [r for b in compared + more for k, r in zip(b["kind"].to_pylist(), b["rows"].to_pylist(), strict=True) if k == repeats.SPANS]
        spans = repeats.merged(repeats.unpack_rows(repeats.SPAN, blobs))
        rows = [units(t) for t in texts]
        got = [[False] * len(r) for r in rows]
        for k, a, e in zip(spans["key"], spans["at"], spans["end"], strict=True):
            got[k][a:e] = [True] * int(e - a)
        assert got == brute.covered(rows, method.size)


@pytest.mark.parametrize(("seed", "group_bytes"), [(0, 32 << 20), (1, 32 << 20), (2, 3000)])
def test_classes_against_brute_force(spark, seed, group_bytes):
    docs = brute.corpus(seed, 120)
    found = jaccard.jaccard_classes(table(spark, docs).repartition(5), group_bytes=group_bytes, pivots=3).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.jaccard_classes(docs)


def _around_cores(n, groups=4):
    """Texts with one shingle more than a core, which link with the core only."""
    docs = []
    for g in range(groups):
        core = " ".join(f"w{g}x{i}" for i in range(n + 2))
        docs += [(10 * g + 1, core + " left"), (10 * g + 2, core + " right"), (10 * g + 3, "front " + core), (10 * g + 4, core)]
    return docs


@pytest.mark.parametrize("boundary", jaccard.BOUNDARIES)
@pytest.mark.parametrize("n", [9, 10, 18, 19, 20])
def test_lists_over_tasks_against_brute_force(n, boundary):
    """The lists of subsets, without Spark, with the texts dealt to tasks in many ways."""
    import pyarrow as pa

    if n + 1 > boundary * 100 // 90:
        return
    docs, classes = _around_cores(n), jaccard.size_classes(boundary, 100, 90)
    want = brute.jaccard_classes(docs)
    for seed in range(8):
        r = random.Random(seed)
        tasks = [[d for d in docs if d[0] % 10 < 4], [d for d in docs if d[0] % 10 == 4]] if seed == 0 else [[], [], []]
        for d in docs if seed else ():
            r.choice(tasks).append(d)
        sent, name = [], {}
        for task in filter(None, tasks):
            batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for _, t in task], pa.binary())], names=[repeats.TEXT])
            for b in jaccard._members(3)(iter([batch.append_column("key", pa.array([k for k, _ in task]))])):
                name.update(zip(b["key"].to_pylist(), b["node"].to_pylist(), strict=True))
            sent += list(jaccard._entries(3, 90, boundary, classes, 1)(iter([batch])))
        edges = jaccard._list_edges(90)(pa.Table.from_batches(sent)).to_pylist()
        root = {v: k for k, v in name.items()}
        for _ in docs:
            for e in edges:
                if e["kind"] == jaccard.LINK:
                    root[e["a"]] = root[e["b"]] = min(root[e["a"]], root[e["b"]])
        assert {k: root[v] for k, v in name.items()} == {k: c for k, (_, c) in want.items()}, (n, boundary, seed)


def test_sets_that_only_a_third_set_links(spark):
    """The third set is in another task."""
    docs = _around_cores(10)
    apart = [table(spark, [d for d in docs if (d[0] % 10 == 4) == core]).coalesce(1) for core in (False, True)]
    found = jaccard.jaccard_classes(apart[0].unionAll(apart[1])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.jaccard_classes(docs)


def test_lists_miss_no_pair():
    """Sets with a tenth of their elements changed share a list, whatever their size."""
    r = np.random.default_rng(5)
    for n in (*range(1, 45), 80, 200, 777):
        for _ in range(6):
            one = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            gone, new = sorted(r.integers(0, n // 10 + 1, 2))
            other = np.unique(np.concatenate([one[gone:], r.integers(0, 1 << 63, new).astype(np.uint64)]))
            common = len(np.intersect1d(one, other))
            if 100 * common < 90 * (len(one) + len(other) - common) or not len(other):
                continue
            hashes, bounds = np.concatenate([one, other]), np.array([0, len(one), len(one) + len(other)])
            for boundary in jaccard.BOUNDARIES[:2]:
                lists = [set(), set()]
                for i, names, _ in jaccard.light_entries(hashes, bounds, 90, boundary * 100 // 90):
                    lists[i] |= set(names.tolist())
                for i, name in zip(*jaccard.heavy_entries(hashes, bounds, jaccard.size_classes(boundary, 1000, 90), 90), strict=True):
                    lists[i].add(int(name))
                assert lists[0] & lists[1], (n, gone, new, boundary)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(500, k) for k in range(501, 560)] + [(k, k + 1) for k in range(700, 740)]
    found = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[find(a)] = find(b)
    for a, b in edges:
        if a != b:
            assert found[a] == found[b]
    used = [n for n in root if n in found]
    assert len({found[n] for n in used}) == len({find(n) for n in used})


def test_best_fit_decreasing_on_counts():
    for seed in range(150):
        r = random.Random(seed)
        length = r.choice([8, 16, 50])
        items = [r.randint(1, length) for _ in range(r.randint(0, 120))]
        runs, n = packing.best_fit_decreasing(dict(Counter(items)), length)
        bins = {}
        for size, _, count, first, each, used in runs:
            for j in range(count):
                bins.setdefault(first + j // each, []).append((used + (j % each) * size, size))
        for parts in bins.values():
            ends = 0
            for at, size in sorted(parts):
                assert at == ends
                ends += size
        assert len(bins) == n
        assert sorted(length - sum(s for _, s in p) for p in bins.values()) == brute.best_fit_decreasing(items, length)


def test_ranks_and_tokenizer_file_agree():
    r = random.Random(1)
    letters = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC)]
    texts = ["".join(r.choice(letters) if r.random() < 0.6 else r.choice(" \n'ab1") for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["", " ", "a  b", "<|endoftext|> hi", "\u3000 z", "\x85 q", "語 \u200b", "a\x1c b"]
    assert packing.encoder(*TOKENIZER)(texts) == packing.encoder(TOKENIZER[0], None)(texts)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y", "http://example.net/EN/", "http://net", "https://x.org/fr/1#t", "ftp://a.b.example.com/de/", "http://notexample.com/de/", "http://example.com/dex", "http://net/", "x://net/?://org/fr/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(3, "http://a.net/", "h")] * 3 + [(None, "http://a.net/", "h")], "page_id long, url string, rule string")
    rules = spark.createDataFrame(list(URL_RULES.items()), "rule string, verdict string")

    def judge(u):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
            tail = rest[cut:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [r for r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        return host, path, rule, URL_RULES.get(rule, "allow")

    want = Counter((r["page_id"], *judge(r["url"])) for r in pages.collect())
    for chars in (4_000_000, 0):  # the list sent to all, and shuffled
        url_filter.MAX_LIST_CHARS, before = chars, url_filter.MAX_LIST_CHARS
        try:
            assert Counter(map(tuple, url_filter.filter_urls(pages, rules).collect())) == want
        finally:
            url_filter.MAX_LIST_CHARS = before
    none = url_filter.filter_urls(pages, rules.limit(0)).collect()
    assert len(none) == pages.count() and {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


def test_url_plan_is_native_and_has_a_filter(spark):
    rules = spark.sql("select 'net/' as rule, 'block' as verdict")
    plan = url_filter.filter_urls(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
    assert "html" not in plan


def test_bloom_filter_never_loses_a_rule(spark):
    rules = spark.range(5000).select(F.concat(F.lit("h"), "id", F.lit(".com/")).alias("rule"), F.lit("block").alias("verdict"))
    pages = spark.range(8000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), "id", F.lit(".com/a")).alias("url"))
    found = url_filter.filter_urls(pages, rules).groupBy("verdict").count().collect()
    assert dict(map(tuple, found)) == {"block": 5000, "allow": 3000}


def test_disguised_words_are_restored(spark):
    words = ["idiot", "stupid", "pathetic", "worthless", "the", "other", "letter", "garden"]
    corpus = spark.createDataFrame([(i, " ".join(words[(i + k) % 8] for k in range(30))) for i in range(40)], "doc_id long, text string")
    model = toxicity.character_model(corpus)
    for written in ("1d10t", "id!ot", "idiooot", "i.d.i.o.t", "i-d-1-0-t", "1D1OT".lower()):
        assert toxicity.restore(written, model) == "idiot", written
    assert toxicity.restore("$tup1d", model) == "stupid"
    assert toxicity.restore("p4th3t1c", model) == "pathetic"
    assert toxicity.restore("idiot", model, spaced=True).replace(" ", "") == "idiot"


def test_disguised_texts_are_scored(spark):
    r = random.Random(2)
    neutral = [f"{a}{b}{c}" for a in ("ga", "lo", "mi", "ter") for b in ("ron", "lis", "den") for c in ("", "ta", "el", "um")]
    clean = lambda: " ".join(r.choice(neutral) for _ in range(40))
    docs = [(i, clean() + (" you stupid idiot " if i % 4 == 0 else " ") + clean()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, labels, F.lit(True))
    tests = [clean() + f" {w} " + clean() for w in ("idiot", "1d10t", "stuuupid", "i d i o t", "s.t.u.p.i.d", "$tup1d!", "garonta", "4 5 0", "")]
    scores = [x["score"] for x in toxicity.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert all(s >= 0.7 for s in scores[:6]), scores
    assert all(s < 0.3 for s in scores[6:]), scores


def test_long_disguised_stretches_are_read():
    """Above 200 letters, written letter by letter or joined by signs."""
    words = ["you", "stupid", "idiot", "garden", "letter", "other"]
    plain = [(" ".join(words[(i * k) % 6] for i in range(30))).encode() for k in range(1, 40)]
    seen = np.ones((64, 64, 64))
    for c in (toxicity.CLASSES[np.frombuffer(b" " + x + b" ", np.uint8)] for x in plain):
        np.add.at(seen, (c[:-2], c[1:-1], c[2:]), 50)
    model = np.log(seen / seen.sum(2, keepdims=True)).astype(np.float32)
    filler = ["garden", "letter", "other"] * 20
    wanted = np.sort(toxicity.word_features(["idiot"]))
    for said in ([*filler, "you", "idiot", *filler], ["idiot", *filler], [*filler, "1d10t"]):
        letters = "".join(said)
        assert len(letters) > 250
        for written in (" ".join(letters), ".".join(letters), "_".join(letters), ".".join(said), "-" * 7 + "_" * 900 + ".".join(said)):
            raw = np.frombuffer(("so " + written + " so").encode(), np.uint8)
            _, found = toxicity.Reader(model, wanted).features(raw, np.array([0, len(raw)]))
            assert len(found) == len(wanted), written[:40]
    # Putting shared parts of the path aside changes nothing.
    for spaced in (False, True):
        r = random.Random(5)
        text = "".join(r.choice("idotsupe10$.*_") for _ in range(300))
        want, before = toxicity.restore(text, model, spaced), toxicity.SETTLE
        try:
            toxicity.SETTLE = 1 << 30
            assert toxicity.restore(text, model, spaced) == want
        finally:
            toxicity.SETTLE = before


def test_paraphrase_is_found_and_topic_is_not(spark):
    r = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("ar", "el", "in", "om", "ut") for c in ("ba", "do", "ke", "li", "")]
    text = lambda n: " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))
    item = text(40).split()
    para = [w if i % 5 else "changed" for i, w in enumerate(item)]
    para[7:7] = ["and", "more"]
    shuffled = item[:]
    r.shuffle(shuffled)
    docs = [(i, text(300)) for i in range(60)]
    docs += [(100, text(90) + " " + " ".join(item) + " " + text(50)), (101, text(33) + " " + " ".join(para).upper() + ". " + text(90)), (102, text(90) + " " + " ".join(shuffled)), (103, " ".join(item[:12]) + " " + text(100))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, text(20)), (3, None), (4, "too short")], "item_id long, text string")
    found = decontaminate.find_leaks(df, bench)
    assert {(x["doc_id"], x["item_id"]) for x in found.collect()} == {(100, 1), (101, 1)}
    kept = decontaminate.without_leaks(df, bench)
    assert {x["doc_id"] for x in kept.collect()} == {k for k, _ in docs} - {100, 101}


def test_cuts_of_long_items_hold_every_word():
    for n in range(decontaminate.LEAST, 400):
        words = [f"w{i}" for i in range(n)]
        cuts = decontaminate.items_of(1, " ".join(words))
        assert set(np.concatenate([c.words for c in cuts])) == set(decontaminate._one(" ".join(words))), n
        assert all(len(c.words) <= 64 for c in cuts) and all(len(c.words) >= 32 for c in cuts if n > 64)


def test_end_of_a_long_item_is_found(spark):
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    item = text("q", 96).split()
    docs = [(i, text(f"d{i}x", 200)) for i in range(20)] + [(100, text("e", 70) + " " + " ".join(item[64:]) + " " + text("f", 70))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.find_leaks(df, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert [(x["doc_id"], x["item_id"], x["common"]) for x in found] == [(100, 1, 1.0)]


@pytest.mark.parametrize("n", [5, 6, 8, 13, 17, 30, 33, 60])
def test_items_in_running_text_are_found(n):
    """Common words as items, whole and with 7 in 10 of their words, among rare ones."""
    r = random.Random(n)
    idf = np.full(decontaminate.BINS, 2.5, np.float32)
    common = [f"common{i}" for i in range(400)]
    idf[decontaminate._bins(decontaminate._one(" ".join(common)))] = 1.2
    asked = [r.sample(common, n) for _ in range(20)]
    items = [decontaminate.Item(i, decontaminate._one(" ".join(w)), decontaminate._one(w[-1])) for i, w in enumerate(asked)]
    terms = np.unique(np.concatenate([i.words for i in items]))
    factors = np.eye(len(terms), dtype=np.float32)
    search = decontaminate.Search(items, idf, terms, factors)
    rare = lambda k: [f"rare{r.randrange(10**6)}" for _ in range(k)]
    for kept in (1.0, 0.7):
        texts = []
        for w in asked:
            gone = set(r.sample(range(n - 1), int((1 - kept) * (n - 1))))
            held = [rare(1)[0] if i in gone else x for i, x in enumerate(w)]
            texts.append(" ".join(rare(r.randrange(60, 160)) + held + rare(100)).encode())
        found = search.find(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        assert {(i, i) for i in range(20)} <= set(found), kept


def test_factors_keep_the_full_cosine(spark):
    """The randomised SVD against the vectors themselves."""
    r = np.random.default_rng(1)
    items = [decontaminate.Item(i, r.integers(0, 400, 30).astype(np.uint64), np.zeros(0)) for i in range(25)]
    idf = r.random(decontaminate.BINS).astype(np.float32) + 0.5
    terms, factors = decontaminate.term_factors(spark, items, idf)
    dense = np.zeros((25, len(terms)))
    for i, item in enumerate(items):
        t, w = decontaminate.weighted(item.words, idf)
        dense[i, np.searchsorted(terms, t)] = w
    assert np.allclose(dense @ dense.T, (dense @ factors) @ (dense @ factors).T, atol=1e-3)


def test_tree_moves_only_into_changed_subtrees(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    heavier = sharding.even_tree(16, {5: 3.0})
    both = sharding.with_shard(sharding.with_shard(keys, "k", sharding.even_tree(16), "a"), "k", heavier, "b").collect()
    moved = [(r["a"], r["b"]) for r in both if r["a"] != r["b"]]
    # Shard 5 is in the first region (0 to 7): nothing moves inside the other.
    assert moved and all(b < 8 for _, b in moved)
    share = sum(r["b"] == 5 for r in both) / len(both)
    assert 0.11 < share < 0.23  # 3 of 18


def test_pipeline_against_its_parts(spark, tmp_path):
    """The stages over a small folder against plain versions of them."""
    docs = brute.corpus(11, 80)
    r = random.Random(8)
    item = " ".join(f"quiz{r.randrange(10**6)}" for _ in range(30))
    docs += [(900, f"{docs[-1][1] or ''} some words before {item} and some behind it")]
    table(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()

    verdicts = {x["doc_id"]: x["kept"] for x in quality.apply_rules(table(spark, docs)).collect()}
    left = [(k, t) for k, t in docs if verdicts[k]]
    classes = brute.jaccard_classes(left)
    left = [(k, t) for k, t in left if classes[k][1] == k]
    cut = brute.byte_dedup(left)
    left = [(k, cut[k][4].decode("utf-8", "ignore")) for k, _ in left]
    left = [(k, t) for k, t in left if brute.words(t) or not cut[k][1]]
    assert any(item in t for _, t in left)
    left = [(k, t) for k, t in left if item not in t]
    ids = {k: [*i, 0] for (k, _), i in zip(left, packing.encoder(*TOKENIZER)([t for _, t in left]), strict=True)}
    want = Counter((k, zlib.crc32(np.array(v, "<u4").tobytes())) for k, v in ids.items() if len(v) <= 2048)
    assert Counter((x["doc_id"], x["ids_crc32"]) for x in rows if x["length"] == len(ids[x["doc_id"]])) == want
    assert {x["doc_id"] for x in rows} == set(ids)


def test_near_copies_of_one_word_in_fifty_go(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    docs, copies = [], []
    for i, n in enumerate((50, 100, 500, 2000)):
        text = [r.choice(words) for _ in range(n)]
        changed = list(text)
        for at in range(25, n, 50):
            changed[at] = "other"
        docs += [(10 * i, " ".join(text)), (10 * i + 1, " ".join(changed))]
        copies.append(10 * i + 1)
    left = {x["doc_id"] for x in jaccard.one_of_each(table(spark, docs), shingle=5, threshold=80).collect()}
    assert left == {k for k, _ in docs} - set(copies)
    want = brute.jaccard_classes(docs, threshold=80, shingle=5)
    assert left == {k for k, (_, c) in want.items() if c == k}


@pytest.mark.parametrize("seed", range(2))
def test_five_words_and_four_fifths_against_brute_force(spark, seed):
    docs = brute.corpus(seed + 20, 90)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_classes(table(spark, docs), shingle=5, threshold=80).collect()}
    assert got == brute.jaccard_classes(docs, threshold=80, shingle=5)


def test_nothing_else_imports_this_subpackage():
    import pathlib

    root = pathlib.Path(sys.modules["corpusprep"].__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "corpusprep.llm" not in path.read_text()


def test_numbers_of_rows_with_one_key_are_long(spark):
    """2,097,152 rows in one part of the numbering are beyond a 32-bit product."""
    rows = repeats.numbered(table(spark, EDGES), "doc_id", "text", [])
    assert rows.schema[repeats.SEQ].dataType.simpleString() == "bigint"
    far = spark.range(1).select(F.expr("cast(id + 3000000 as int)").alias("place"))
    assert far.select(F.col("place").cast("long") * repeats.NUMBERING).first()[0] == 3_072_000_000
    assert 3_072_000_000 < 1 << 32  # the width of a sequence number in packed rows


def test_new_shards_take_rows_only_into_themselves(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    for n in (16, 17, 18, 21):
        both = sharding.with_shard(sharding.with_shard(keys, "k", sharding.even_tree(n), "a"), "k", sharding.even_tree(n + 1), "b").collect()
        moved = [r["b"] for r in both if r["a"] != r["b"]]
        assert moved and set(moved) == {n}


def test_many_rule_shapes_have_one_plan(spark):
    """600 rules of different path lengths: the plan of a short list, the right rule."""
    paths = ["/" + "a" * i for i in range(600)]
    few, many = (spark.createDataFrame([("x.org" + p, "block") for p in ps], "rule string, verdict string") for ps in (paths[:2], paths))
    pages = spark.createDataFrame([(i, f"http://www.X.org/{'a' * i}?q") for i in (0, 1, 77, 700)], "page_id long, url string")
    expressions = [url_filter.filter_urls(pages, rules)._jdf.queryExecution().analyzed().toString().count("substring_index") for rules in (few, many)]
    assert expressions[0] == expressions[1]
    got = {r["page_id"]: r["rule"] for r in url_filter.filter_urls(pages, many).collect()}
    assert got == {0: "x.org/", 1: "x.org/a", 77: "x.org/" + "a" * 77, 700: "x.org/" + "a" * 599}
