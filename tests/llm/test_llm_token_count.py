"""Token counts against one call of the library for each whole text."""

import random

import public_tokenizers
import pytest

from duosync.llm.queries import QUERIES
from duosync.llm.token_count import Pieces, count_tokens, counter, parts_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n\n\n", "▁x ▁ y", "<s> hi </s><unk>",
    "<|endoftext|> x", "你好" * 40, "a" * 700, " " * 900, "\x00\x01\n", "\U0001f600 é́ Ⅳ",
]


def random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    words = ["the", "of", "Straße", "мир", "中文", "x1y2", "12345", "...", "\n", "\t", " ", "▁", "é"]
    return [
        rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randint(0, 300)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_parts_have_the_tokens_of_the_text(size):
    model = Pieces(MODEL)
    assert model.splits
    more = 0
    for text in [t for t in ODD if t] + random_texts(3, 60):
        cut = parts_of(model, text, len(text.encode()), size)
        more += len(cut) > 1
        whole = len(model.model.encode(text))
        assert sum(model.lengths(cut)) - model.lead_tokens * (len(cut) - 1) == whole, text
    assert more > 30


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_counts(spark, path):
    texts = ODD + random_texts(5, 40) + ["word and more " * 20_000]
    rows = [(i if i else None, t, -1) for i, t in enumerate(texts)] + [(1, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    got = count_tokens(docs, path, limit=100, part_bytes=64, batch_bytes=300).collect()
    model = counter(path)
    want = [
        (i, len((t or "").encode()), model.lengths([t or ""])[0]) for i, t, _ in rows
    ]
    want = sorted((*w, w[2] > 100) for w in [(i or -1, b, n) for i, b, n in want])
    assert sorted((r[0] or -1, *r[1:]) for r in got) == want
    assert any(r.over_limit for r in got) and not all(r.over_limit for r in got)


def test_limit_is_not_over(spark):
    n = len(Pieces(MODEL).model.encode("one two three"))
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    assert not count_tokens(docs, MODEL, limit=n).first().over_limit
    assert count_tokens(docs, MODEL, limit=n - 1).first().over_limit


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert count_tokens(docs, MODEL).collect() == []


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    model = Pieces(MODEL).model
    assert len(got) == len(docs)
    for d in docs:
        n = len(model.encode(d.text or ""))
        assert got[d.doc_id][1:] == (len((d.text or "").encode()), n, n > 4096)
