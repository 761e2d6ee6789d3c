import collections
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import duosync.llm.minhash as minhash
from duosync.llm.common import Scratch
from duosync.llm.components import components
from duosync.llm.minhash import near_duplicates, shingles, signature

SCHEMA = "doc_id long, text string, bucket string, node string, component string, digest string"


def frame(spark, rows, parts=3):
    data = [(i, t, "b", "n", "c", "d") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def sets(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    """Components by comparing every pair that shares a shingle."""
    made = [(i, sets(t)) for i, t in rows]
    first = {}
    for i, s in made:
        if s:
            first[s] = min(first.get(s, i), i)
    distinct = list(first)
    holders = collections.defaultdict(list)
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(distinct):
        shared = collections.Counter(h for x in s for h in holders[x])
        for h, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(distinct[h]) - both):
                parent[root(k)] = root(h)
        for x in s:
            holders[x].append(k)
    label = {}
    for k, s in enumerate(distinct):
        label[root(k)] = min(label.get(root(k), first[s]), first[s])
    place = {s: label[root(k)] for k, s in enumerate(distinct)}
    return {i: (len(s), place.get(s, i)) for i, s in made}


def check(spark, rows):
    got = near_duplicates(frame(spark, rows), Scratch(spark)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def family(rng, n, words=60, changes=2):
    """Texts that come from one another by a few changed words: links chain through a group."""
    text = [rng.choice("abcdefghijklmnopq") * rng.randint(1, 6) for _ in range(words)]
    for _ in range(n):
        for _ in range(changes):
            text[rng.randrange(words)] = "".join(rng.choices("xyz", k=5))
        yield " ".join(text)


@pytest.mark.parametrize("block", [7, 512])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    texts = [t for _ in range(25) for t in family(rng, rng.randint(1, 30), rng.randint(20, 90))]
    texts += ["same  TEXT\nof five words", "Same text of\x0bfive words", "SAME text of five"]
    texts += ["two words", "TWO\twords", "", None, " \n", "É é", "é É", "one", "w " * 50_000]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check(spark, [(r.doc_id, r.text) for r in docs])


def test_odd_rows(spark):
    text = "a b c d e f g"
    rows = [(5, text)] * 3 + [(7, text), (5, "h i j k l m"), (6, "h i j k l m"), (8, None)]
    rows += [(None, "z z z z z z"), (None, None), (3, ""), (3, "")]
    got = near_duplicates(frame(spark, rows), Scratch(spark)).collect()
    assert len(got) == len(rows)
    by = collections.Counter((r.doc_id, r.component_id, r.kept) for r in got)
    assert by == {
        (5, 5, True): 4, (7, 5, False): 1, (6, 5, False): 1, (8, 8, True): 1,
        (None, None, True): 2, (3, 3, True): 2,
    }
    assert near_duplicates(frame(spark, []), Scratch(spark)).count() == 0


def test_signature_estimates_similarity():
    a, b = (shingles(" ".join(map(str, range(s, s + 900))).encode()) for s in (0, 100))
    both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a) == signature(b)).mean() - both) < 0.15


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(99)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    edges = spark.createDataFrame([*pairs, (None, 1), (1, None)], "u long, v long")
    got = components(edges, Scratch(spark)).collect()
    assert len(got) == len(linked)
    assert {r.node: r.component for r in got} == {x: root(x) for x in linked}
    none = components(spark.createDataFrame([], "u long, v long"), Scratch(spark))
    assert none.count() == 0


def test_steps_of_components_are_few_files(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {name: spark.conf.get(name) for name in names}
    edges = spark.createDataFrame([(i, i * 7 % 300) for i in range(300)], "u long, v long")
    scratch = Scratch(spark)
    try:
        for name, value in zip(names, ("64", "false"), strict=True):
            spark.conf.set(name, value)
        scratch(components(edges, scratch))
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    written = [spark.read.parquet(f"{scratch.folder}/{i}") for i in range(scratch.count)]
    assert len(written) > 5
    assert max(len(df.inputFiles()) for df in written[1:]) <= 8


def test_a_written_frame_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(setting)
    numbers = spark.range(0, 20_000, 1, 4).withColumn("k", F.xxhash64("id"))
    written = Scratch(spark)(numbers.groupBy("k").count().orderBy("k"))
    end = time.monotonic() + 10
    while files() - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not files() - before
    assert written.count() == 20_000 and spark.conf.get(setting) == was
