"""Every registered query of the subpackage: against SQL where SQL can express it."""

import zlib
from collections import Counter, defaultdict

import pytest
from oracle import duck, oracle_rows, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as registry
from corpusprep.llm.queries import ORACLES, QUERIES, TOKENIZER, URL_RULES

NO_SQL = {"op1_toxicity", "op3_language_centroids", "op8_latent_decontamination", "op10_best_fit_packing", "op11_tokenizer_alignment"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    # Numbering every byte's window takes DuckDB long: a smaller table for that one.
    folder = "/root/testdata/sf0.001" if name.startswith("op7") else "/root/testdata/sf0.01"
    columns, rows = rows_of(QUERIES[name](spark, folder))
    expected_columns, expected = oracle_rows(duck(folder), ORACLES[name])
    assert columns == expected_columns
    assert sum(rows.values()) > 0
    assert rows == expected


def test_all_are_registered():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert {*QUERIES, "pipeline"} <= set(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def _fold(folds):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def test_languages_of_held_out_documents(spark, sf):
    rows = QUERIES["op3_language_centroids"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = rows.join(truth, "doc_id").collect()
    assert len(found) == 1000
    held_out = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held_out) >= 0.97 * len(held_out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)


def test_toxic_held_out_documents(spark, sf):
    rows = QUERIES["op1_toxicity"](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    assert rows.count() == 1000
    found = [r for r in rows.join(truth, "doc_id").collect() if r["held_out"]]
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)
    toxic = [r for r in found if r["toxic"] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.7 * len(toxic)
    assert not any(r["predicted"] for r in found if r["toxic"] == 0)


def test_leaks_against_every_passage(spark, sf):
    """Documents that hold an item's words in one piece are found, all others are not."""
    from brute import words

    clean = lambda t: [w for w in (w.lower().strip("".join(c for c in map(chr, range(33, 127)) if not c.isalnum())) for w in words(t)) if w]
    items = {r[0]: clean(r[1]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()}
    want = set()
    for key, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        row = " " + " ".join(clean(text)) + " "
        want |= {(key, i) for i, w in items.items() if " " + " ".join(w) + " " in row}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_latent_decontamination"](spark, sf).collect()}
    assert want and got == want


def test_packing_holds_every_token_once(spark):
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op10_best_fit_packing"](spark, folder).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER[0])
    docs = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(docs)
    for key, pieces in by_doc.items():
        ids = [*tokenizer.encode(docs[key] or "", add_special_tokens=False).ids, 0]
        at = 0
        for i, p in enumerate(sorted(pieces, key=lambda p: p["piece"])):
            part = ids[at : at + p["length"]]
            assert (p["piece"], p["start"]) == (i, at) and (i == 0 or p["length"] == 2048)
            assert p["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += p["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048
    from brute import best_fit_decreasing

    rooms = sorted(2048 - sum(n for _, n in parts) for parts in by_sequence.values())
    assert rooms == best_fit_decreasing([r["length"] for r in rows], 2048)


def test_rules_of_the_task():
    assert URL_RULES == {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def test_shards_follow_the_law(spark, sf):
    rows = QUERIES["op6_hash_tree_shards"](spark, sf).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in rows)
    moved = sum(r["grown_shard"] == 16 for r in rows)
    assert 0.02 * len(rows) < moved < 0.12 * len(rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) < 2 * len(rows) / 16
    assert Counter(r["law"] for r in rows) == {"key": len(rows)}
