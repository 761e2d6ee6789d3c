import collections
import math
import random
import zlib

import pytest

import duosync.llm.katz as katz
from duosync.llm.common import Scratch
from duosync.llm.katz import Tokens, discounts, score_texts

SCHEMA = "doc_id long, text string, n string, key string, a string, word string"


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w] + ["</s> "]


class Brute:
    """The model by its definition, over plain dictionaries."""

    def __init__(self, rows):
        held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
        self.held = held
        train = [tokens_of(t) for i, t in rows if not held(i)]
        self.one = collections.Counter(w for t in train for w in t)
        self.two = collections.Counter(p for t in train for p in zip(["<s> ", *t], t))
        self.start = collections.Counter(h for h, _ in self.two.elements())
        self.n = sum(self.one.values())
        of = lambda c: discounts([sum(v == r for v in c.values()) for r in range(1, 7)])
        self.d1, self.d2 = ([1, *of(c)] for c in (self.one, self.two))
        self.after = collections.defaultdict(list)
        for h, w in self.two:
            self.after[h].append(w)

    def single(self, w):
        known = lambda c: (self.d1[c] if c <= 5 else 1) * c / (self.n + 0.1)
        return known(self.one[w]) if self.one[w] else 1 - sum(map(known, self.one.values()))

    def seen(self, h, w):
        r = self.two[h, w]
        return (self.d2[r] if r <= 5 else 1) * r / (self.start[h] + 0.1)

    def pair(self, h, w):
        if not self.start[h]:
            return self.single(w)
        if self.two[h, w]:
            return self.seen(h, w)
        rest = 1 - sum(self.seen(h, x) for x in self.after[h])
        return rest / (1 - sum(self.single(x) for x in self.after[h])) * self.single(w)

    def row(self, i, text):
        t = tokens_of(text)
        base = sum(
            math.log10((self.one[w] + 0.1) / (self.n + 0.1 * (len(self.one) + 1))) for w in t
        )
        score = sum(math.log10(self.pair(h, w)) for h, w in zip(["<s> ", *t], t))
        return (i, self.held(i), len(t), sum(w in self.one for w in t), self.n, base, score)


def compare(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)
    got = sorted(map(tuple, score_texts(frame, Scratch(spark)).collect()), key=str)
    model = Brute(rows)
    want = sorted((model.row(*r) for r in rows), key=str)
    assert len(got) == len(want)
    key = lambda r: (*map(str, r[:5]), round(r[5], 6), round(r[6], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], abs=1e-8)
    return model


def corpus(n=400):
    rng = random.Random(8)
    words = ["the", "THE", "of", "é", "É"] * 4 + [f"w{int(rng.paretovariate(0.8))}" for _ in range(300)]
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(n)]
    rows += [(1000, None), (1001, ""), (7, rows[7][1]), (7, rows[7][1]), (None, "the of é"), (10, "new words here")]
    return rows


@pytest.mark.parametrize("part_tokens", [100, 5_000_000])
def test_against_brute_force(spark, monkeypatch, part_tokens):
    monkeypatch.setattr(katz, "PART_TOKENS", part_tokens)
    model = compare(spark, corpus())
    for h in ["<s> ", "the", "of", "w1", "w2", "never seen"]:
        total = sum(model.pair(h, w) for w in [*model.one, "never seen"])
        assert total == pytest.approx(1)


def test_hot_pairs(spark, monkeypatch):
    """Pairs in more than three documents of a block go apart: frequent, rare and unseen ones."""
    monkeypatch.setattr(katz, "PART_TOKENS", 100)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 2500)
    monkeypatch.setattr(katz, "HOT_DOCS", 3)
    held = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = corpus() + [(i, "never learned here, the of " + "x y x " * (i % 3)) for i in held[-150:]]
    rows += [(i, "x y x") for i in (5001, 5002)] + [(6000 + i, "on off " * 200) for i in range(40)]
    compare(spark, rows)
    frame = spark.createDataFrame([r for r in rows], "doc_id long, text string").repartition(3)
    _, tokens = katz.count_tokens(frame, Scratch(spark))
    assert tokens.hot < 5
    sent = spark.sparkContext.broadcast(tokens)
    shares = frame.mapInArrow(katz._send(sent), katz.SHARE)
    found = Scratch(spark)(shares.groupBy("part").applyInArrow(katz._meet(sent), katz.FOUND))
    seen = {r.n for r in found.filter(f"kind = {katz.ANSWER}").collect()}
    assert 0 in seen and seen & {1, 2, 3, 4, 5} and max(seen) > 1000
    # The 8,000 repeats of one pair are 40 rows at most.
    assert found.filter(f"kind = {katz.HOT} AND n > 100").count() <= 80


def test_small_and_empty(spark):
    compare(spark, [(1, "a b a"), (2, None)])
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    compare(spark, [(held, "only held out"), (None, None)])  # nothing to learn from
    none = spark.createDataFrame([], SCHEMA)
    assert score_texts(none, Scratch(spark)).count() == 0


def test_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = score_texts(docs, Scratch(spark)).filter("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_discounts():
    assert all(0 < d < 1 for d in discounts([100, 40, 20, 12, 9, 6]))
    for odd in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 9, 9, 9, 9, 9]):
        assert all(0 < d < 1 for d in discounts(odd))
    known = Tokens(1000, 50, [20, 10, 5, 3, 2, 1], 10)
    assert known.unknown > 0


@pytest.mark.parametrize(
    "counts",
    [
        [215810, 61309, 26017, 14862, 13741, 7222],  # tokens and pairs of the given documents
        [1655711, 262472, 56325, 23262, 20048, 8151],
        [100, 30, 0, 8, 5, 0],
    ],
)
def test_good_turing_on_uneven_counts(counts):
    got = discounts(counts)
    assert all(0 < d < 1 for d in got) and got == sorted(got)
    share = counts[0] / (counts[0] + 2 * counts[1])
    assert got != pytest.approx([1 - share / r for r in range(1, 6)], abs=1e-3)
    # On a straight line it is Katz's form itself, and one count moves nothing far.
    line = [1e9 / r**2.2 for r in range(1, 7)]
    rest = 6 * line[5] / line[0]
    want = [((r + 1) * line[r] / line[r - 1] / r - rest) / (1 - rest) for r in range(1, 6)]
    assert discounts(line) == pytest.approx(want)
    for k in range(6):
        moved = [n * (1.05 if i == k else 1) for i, n in enumerate(counts)]
        assert discounts(moved) == pytest.approx(got, abs=0.05)


def test_parts_give_rows_only_for_texts_they_have(spark, monkeypatch):
    monkeypatch.setattr(katz, "PART_TOKENS", 20)
    rows = [(i, f"w{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, tokens = katz.count_tokens(docs, Scratch(spark))
    assert tokens.parts > 20
    sent = spark.sparkContext.broadcast(tokens)
    found = docs.mapInArrow(katz._send(sent), katz.SHARE).groupBy("part")
    texts = found.applyInArrow(katz._meet(sent), katz.FOUND).filter(f"kind = {katz.TEXT}")
    # A word and an end each.
    assert 300 <= texts.count() <= 600
