"""Alignment of two tokenizers against a plain merge of each text."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import alignment
from corpusprep.llm.queries import QUERIES, TOKENIZER

A, RANKS = TOKENIZER
B = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(A)
    file.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_of = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("\u2581", " ").encode()
    rows, counts = [], Counter()
    for key, text in docs:
        body = (" " + (text or "")).encode()
        a = file.encode(body.decode(), add_special_tokens=False)
        # Byte-level tokens are stretches of the text: their ends follow from what they decode to.
        size_a = [len(alignment_bytes(file.id_to_token(i))) for i in a.ids]
        b = model.encode(text or "")
        parts_b = [bytes_of(model.id_to_piece(i)) for i in b]
        if not text or b"".join(parts_b) != body or sum(size_a) != len(body):
            rows.append((key, [], [], []))
            continue
        groups, i, j, end_a, end_b, left, right = [], 0, 0, 0, 0, [], []
        while i < len(a.ids) or j < len(b):
            if end_a <= end_b and i < len(a.ids):
                end_a += size_a[i]
                left.append(a.ids[i])
                i += 1
            else:
                end_b += len(parts_b[j])
                right.append(b[j])
                j += 1
            if end_a == end_b:
                groups.append((left, right))
                left, right = [], []
        counts.update((p[-1], q[-1]) for p, q in groups)
        rows.append((key, a.ids, b, groups))
    best = defaultdict(int)
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    out = []
    for key, a, b, groups in rows:
        links = [(p[-1], q[-1]) for p, q in groups]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((key, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return Counter(out)


def alignment_bytes(token):
    """Each character of a byte-level token stands for one byte."""
    return token.encode("utf-32-le")[::4]


EDGES = [(1, None), (2, ""), (3, " "), (None, "a b"), (None, "a b"), (4, "under\u2581score"), (5, "x\x00y \x1c"), (6, "end <|endoftext|> of <s> it </s><unk>"), (7, "\u00e9\u65e5\u672c \U0001f642 \u2028"), (7, "\n\n\t  \r\n"), (8, "<0x41> \u00a0\ufb01"), (9, "x" * 3000)]


def random_docs(seed):
    r = random.Random(seed)
    words = ["the", "tokenization", "Straße", "naïve", "http://a.b/c?d=1", "1234567", "日本", "  ", "\n", "e\u0301", "!!!"]
    return [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 5, 60])))) for i in range(30)]


@pytest.mark.parametrize("work,slice_bytes", [(alignment.WORK, alignment.SLICE_BYTES), (5, 700), (64, 1 << 20)])
def test_against_a_plain_merge(spark, work, slice_bytes):
    docs = EDGES + random_docs(work)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3).withColumn("row", F.lit("clash")).withColumn("n_a", F.lit(1))
    made = alignment.align(df, A, B, RANKS, work=work, slice_bytes=slice_bytes)
    assert made.documents.columns == COLUMNS
    assert Counter(map(tuple, made.documents.collect())) == plain(docs)
    sizes = [len(r["a"]) // 2 + len(r["b"]) // 2 for r in made.pieces.collect()]
    assert max(sizes) <= work + 1
    if work == 64:  # pieces in the middle of a slice have equal work
        assert sum(work <= s <= work + 1 for s in sizes) > len(sizes) // 2


def test_without_ranks_and_empty_table(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    assert Counter(map(tuple, alignment.align(df, A, B).documents.collect())) == plain(EDGES)
    assert alignment.align(df.limit(0), A, B, RANKS).documents.collect() == []


def test_query_on_the_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, QUERIES["op11_tokenizer_alignment"](spark, folder).collect())) == plain(docs)


@pytest.mark.parametrize("seed", range(200))
def test_cuts_of_the_merge(seed):
    r = random.Random(seed)
    a, b = (np.array(sorted(r.sample(range(60), r.randint(0, 40))), np.int64) for _ in range(2))
    work = r.randint(1, 30)
    i, j = alignment.cut_merge(a, b, work)
    assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
    for k in range(1, len(i) - 1):
        assert k * work <= i[k] + j[k] <= k * work + 1
        before = [*a[: i[k]], *b[: j[k]]]
        assert max(before, default=-1) < min([*a[i[k] :], *b[j[k] :]], default=99)


def test_every_link_has_a_place_of_its_own():
    voc = alignment.Vocabularies([b"a", b"b", b"ab", b"cab", b" "], [b"b", b"ab", b"b", b"cab", b"a", b"dcab", b" "])
    pairs = [(i, j) for i, x in enumerate(voc.a) for j, y in enumerate(voc.b) if x.endswith(y) or y.endswith(x)]
    places = voc.link(*(np.array(p) for p in zip(*pairs, strict=True)))
    assert len(set(places.tolist())) == len(pairs) and max(places) < voc.links
