import collections
import functools
import zlib

import numpy as np
import pytest

from duosync.llm.common import Scratch
from duosync.llm.pack import CAPACITY, Remembered, TokenBytes, cut, pack
from duosync.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, length string, start string, _class string"
TEXTS = [
    "Hello, the world's BIGGEST don't we'll 12 3!! a\tb\r\nc  d\n\n",
    "Èleou éçtion, für ßtraße. Σίσυφος ΟΔΟΣ İstanbul ǅ éa  x y z\x1c",
    "日本語 text， 한국어 emoji 😀😀 ½ ٣٤ x² näive. ﬁn ſo",
    "<|endoftext|> a<|startoftext|>b <|x",
    "'s 't foo's l'été aujourd'hui..,, (x)[y]{z} __a__ a_b-c",
    "",
    "w" * 3000 + " " + "long " * 9000,
]


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def reference(text):
    tok = tokenizer()
    return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", TEXTS)
def test_ids(text):
    encode = TokenBytes(tokenizer_file())
    assert encode(text) == reference(text)
    assert encode(text) == reference(text)  # now from memory


def test_ids_of_given_texts(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    encode = TokenBytes(tokenizer_file())
    assert all(encode(r.text) == reference(r.text) for r in texts)


def test_ids_of_each_latin_character():
    encode = TokenBytes(tokenizer_file())
    for c in map(chr, range(0x180)):
        text = f"a{c}B {c} 1{c}{c}9 {c}'s'{c} e{c}\u0301 \u0130{c}\u2019{c}"
        for part in (text, text[: text.index("\u0301")], text.upper()):
            assert encode(part) == reference(part), hex(ord(c))


def test_cases_are_remembered_once():
    encode = TokenBytes(tokenizer_file())
    text = "Word word WORD wOrd Word. word. WORD. \xc9tude \xe9tude"
    assert encode(text) == reference(text)
    kept = [d for d in vars(encode).values() if isinstance(d, Remembered)]
    assert sum(map(len, kept)) == len({"word", "word.", ".", "\xe9tude"})


def test_cut():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        assert sum(cut(n, CAPACITY)) == n


def check(rows, got, capacity):
    docs, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    want = {i: reference(t or "") + b"\1\0\0\0" for i, t, *_ in rows}
    assert set(docs) == set(want)
    for i, pieces in docs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[i]) // 4
            at += r.length
            assert r.ids_crc32 == zlib.crc32(want[i][4 * r.start : 4 * at])
        assert at == len(want[i]) // 4
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # a power of two: no padding
        assert len({r.length for r in pieces}) == 1  # one class
    full = sum(r.length for r in got) // capacity
    assert len(bins) <= full + sum(range(capacity.bit_length()))


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, capacity):
    rows = [(i, t, "a", "b", "c") for i, t in enumerate(TEXTS)]
    rows += [(100 + i, "some words " * (i * 7 % 40), None, "", "x") for i in range(200)]
    rows += [(900, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(rows, pack(docs, Scratch(spark), tokenizer_file(), capacity).collect(), capacity)


def test_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c", "", "", "")] * 3 + [(None, "x", "", "", "")], SCHEMA)
    got = pack(docs, Scratch(spark), tokenizer_file()).collect()
    assert sum(r.length for r in got) == 3 * 4 + 2
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    none = spark.createDataFrame([], SCHEMA)
    assert pack(none, Scratch(spark), tokenizer_file()).count() == 0
