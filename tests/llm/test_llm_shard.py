import collections
import math
import struct
import zlib

import xxhash

from duosync.llm.common import Scratch
from duosync.llm.shard import assign, moved, shard_documents

SCHEMA = "doc_id long, text string, shard string, _row string, size string"


def owner(key, weights):
    def bid(i, w):
        seed = 42 if key is None else xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        bits = xxhash.xxh64(struct.pack("<i", i), seed=seed).intdigest() >> 11
        return -w / math.log((bits + 0.5) / 2**53)

    return max((bid(i, w), i) for i, w in enumerate(weights))[1]


def test_documents(spark):
    rows = [(i, f"text {i} é" * (i % 5), "x", "y", "z") for i in range(300)]
    rows += [(7, "again", None, None, None)] * 3 + [(None, None, "", "", "")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = shard_documents(docs, Scratch(spark), [1.0] * 24).collect()
    want = collections.Counter()
    for i, text, *_ in rows:
        raw = (text or "").encode()
        want[i, len(raw) + 8, zlib.crc32(raw), owner(i, [1] * 24), owner(i, [1] * 25)] += 1
    assert collections.Counter(
        (r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got
    ) == want
    places = collections.defaultdict(list)
    for r in got:
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert shard_documents(docs, Scratch(spark), [1.0] * 24).count() == 0


def test_weights_and_growth(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    three, four = assign(ids, "doc_id", [1, 2, 1]), assign(ids, "doc_id", [1, 2, 1, 1])
    share = {r.shard: r["count"] / 20_000 for r in three.groupBy("shard").count().collect()}
    assert abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    gone = moved(three, four, "doc_id").collect()
    assert {r.to_shard for r in gone} == {3} and abs(len(gone) / 20_000 - 0.2) < 0.02
