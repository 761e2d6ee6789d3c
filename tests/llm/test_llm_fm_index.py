import hashlib
import random
import re

import numpy as np
import pytest

from duosync.llm.common import Scratch
from duosync.llm.fm_index import FmIndex, WaveletMatrix, hits, merged, scan, suffix_array
from duosync.llm.queries import op5_fm_index

DOCS = "doc_id long, text string, item_id string, _row string, spans string, words string"
ITEMS = "item_id long, text string, doc_id string, _row string"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            name = "" if item is None else str(item)
            windows.setdefault(tuple(words[i : i + n]), set()).add(name)
    lengths = {len(w) for w in windows}
    for doc, text in docs:
        words, hit, names = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        yield doc, len(words), len(hit), len(names), digest, bool(hit)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def check(spark, docs, items, **sizes):
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], DOCS).repartition(2)
    bench = spark.createDataFrame([(*i, "a", "b") for i in items], ITEMS)
    got = hits(scan(frame, bench, Scratch(spark), **sizes)).select(COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(docs, items)))


def corpus():
    rng = random.Random(4)
    vocabulary = [f"{c}{d}" for c in "abcdé" for d in range(6)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(30)]
    items += [(40, "Only, Three words!"), (41, "one"), (42, None), (43, " .. "), (None, "no id at all")]
    items += [(3, "a second text of item three with more than ten words in it"), (44, items[5][1])]
    docs = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            source = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(len(source) + 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = source[cut : cut + rng.randint(1, 25)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    docs += [(200, None), (201, ""), (202, "only THREE-words"), (203, docs[3][1]), (203, docs[4][1])]
    long = rng.choices(vocabulary, k=6000)
    long[2000:2000], long[4095:4095] = items[7][1].split(), items[9][1].split()
    docs += [(300, " ".join(long)), (None, items[0][1]), (1, docs[1][1]), (1, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 64}, {"block_bytes": 300, "shard_words": 1000}])
def test_against_brute_force(spark, sizes):
    check(spark, *corpus(), **sizes)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    read = lambda t, *c: list(map(tuple, spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()))
    docs, items = read("documents", "doc_id", "text"), read("benchmark", "item_id", "text")
    got = op5_fm_index(spark, sf).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs, items))
    assert any(r.contaminated for r in got)


def test_empty_tables(spark):
    check(spark, [], [(1, "a b c")])
    check(spark, [(1, "a b c"), (2, None)], [])


@pytest.mark.parametrize("symbols, size", [(2, 200), (5, 3000), (3000, 5000), (1 << 22, 80)])
def test_index(symbols, size):
    draw = np.random.default_rng(size)
    text = np.concatenate([draw.integers(1, symbols, size), np.ones(3), [0]]).astype(np.int32)
    text[size // 2 : size // 2 + 30] = text[:30]
    order = suffix_array(text)
    plain = text.tolist()
    assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
    index = FmIndex(text)
    asked = np.array([plain[i : i + 4] for i in range(0, 30)] + [[1, 1, 1, 1]])
    low, high = index.search(asked)
    for phrase, a, b in zip(asked.tolist(), low, high):
        places = sorted(index.locate(np.arange(a, b)).tolist())
        assert places == [i for i in range(len(plain)) if plain[i : i + 4] == phrase]


def test_wavelet_matrix():
    values = np.random.default_rng(1).integers(0, 37, 500)
    matrix = WaveletMatrix(values)
    at = np.arange(500)
    symbols, before = matrix.access(at)
    assert (symbols == values).all()
    assert before.tolist() == [int((values[:i] == values[i]).sum()) for i in at]
    assert matrix.rank(np.array([5]), np.array([500]))[0][0] == (values == 5).sum()


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12), (20, 21)]) == [(0, 4), (5, 12), (20, 21)]
