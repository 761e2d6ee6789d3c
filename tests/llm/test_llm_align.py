"""Alignment against a byte-by-byte version without chunks, shared texts or Spark."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from duosync.llm.align import align_documents, align_texts, aligner, pair_counts
from duosync.llm.common import Scratch
from duosync.llm.queries import QUERIES

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    lines = [line.split() for line in open(RANKS, "rb")]
    return a, {int(i): base64.b64decode(t) for t, i in lines}, SentencePieceProcessor(model_file=B)


def owners(parts):
    """The token that each byte belongs to."""
    return [i for i, p in enumerate(parts) for _ in p]


def brute(tokenizers, rows):
    a, a_bytes, b = tokenizers
    seen, counts = {}, Counter()
    for row, (_, text) in enumerate(rows):
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        parts_a = [a_bytes[i] for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        parts_b = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids_b, pieces, strict=True)
        ]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            continue
        of_a, of_b = owners(parts_a), owners(parts_b)
        links = sorted(set(zip(of_a, of_b, strict=True)))
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        groups, start_a, start_b = [], 0, 0
        for k in range(len(whole)):
            last = k + 1 == len(whole)
            if last or (of_a[k + 1] != of_a[k] and of_b[k + 1] != of_b[k]):
                groups.append((ids_a[start_a : of_a[k] + 1], ids_b[start_b : of_b[k] + 1]))
                start_a, start_b = of_a[k] + 1, of_b[k] + 1
        text_of = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        seen[row] = (len(ids_a), len(ids_b), len(groups), pairs, text_of)
        counts.update(pairs)
    most = defaultdict(int)
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for row, (doc_id, _) in enumerate(rows):
        if row not in seen:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, pairs, text_of = seen[row]
        best = sum(counts[p] == most[p[1]] for p in pairs)
        digest = hashlib.sha256(text_of.encode()).hexdigest()
        out.append((doc_id, n_a, n_b, n_groups, len(pairs), best, sum(counts[p] for p in pairs), digest))
    return out


def texts():
    rng = random.Random(11)
    words = ["the", "of", "running", "Straße", "мир", "中文字", "x1y2", "12345", "...", "don't", "\U0001f600", "\n", "\t", "", " ", "é", "\xa0", "\x1c", "<|endoftext|>", "</s>"]
    made = [
        rng.choice([" ", " ", ""]).join(rng.choice(words) for _ in range(rng.randint(1, 60)))
        for _ in range(120)
    ]
    odd = ["a\nb", "\nab", "ab\n", "a.\nb", "it's. a", "x's, y", "e.g. a.b ab: c;d", "É. ß! x? 1. ½.", "a\r\nb", " .", ".", None, "", " ", "  ", "a", " a", "a ", "a \n b", "▁", "a ▁ b", "x▁ y", "a" * 500, "long words here " * 3000]
    return odd + made + ["copied text of many rows"] * 60


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


@pytest.mark.parametrize("often", [1, 50, 10**9])
def test_against_brute_force(spark, tokenizers, often):
    rows = [(i // 2 if i != 7 else None, t) for i, t in enumerate(texts())]
    clash = [(i, t, 5, 6) for i, t in rows]
    docs = spark.createDataFrame(clash, "doc_id long, text string, n_a int, key int").repartition(4)
    got = align_documents(docs, Scratch(spark), A, B, often=often).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(tokenizers, rows), key=key)


def test_texts_are_aligned_once(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(50)] + [(50, "other")], "doc_id long, text string")
    found = Scratch(spark)(align_texts(docs, A, B))
    assert sorted(r.times for r in found.collect()) == [1, 50]
    assert pair_counts(found).agg({"n": "sum"}).first()[0] == sum(
        r.times * r.n_links for r in found.collect()
    )


def test_forgetting_chunks(monkeypatch, tokenizers):
    from duosync.llm import align

    monkeypatch.setattr(align, "REMEMBERED", 3)
    model = align.Aligner(A, B)
    for text in ["one two three four", "five six seven eight", "one two nine"]:
        (chunks,) = model.chunks([text])
        assert sum(c.n_a for c in chunks) == len(tokenizers[0].encode(" " + text).ids)
    assert len(model.known) <= 3 and aligner(A, B) is aligner(A, B)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_documents(docs, Scratch(spark), A, B).collect() == []


def test_given_documents(spark, tokenizers):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op11_alignment"](spark, sf).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(tokenizers, rows), key=key)
