"""Near-duplicate documents by MinHash signatures with banding, and exact confirmation.

1. Each document's distinct five-word shingles become 64-bit numbers; ``HASHES`` universal hash
   functions each keep their minimum over them.
2. Documents with the same set are one from here on: a group of copies costs one document.
3. Signatures are cut into bands; documents that agree on a band share a bucket. Each member of a bucket
   is compared with the bucket's smallest one (a star, not all pairs).
4. Compared means: signatures first, which agree on the fraction of the sets' similarity, then
   the full sets. Confirmed pairs are links; their components come from star steps.
5. Buckets that still hold several components are gone through once more, block by block, with
   the full sets: members in different components are compared in the same two ways until they
   are in one, each pair in the first bucket that it shares. Only links leave the task, so no
   link inside a bucket is missed that could still join two components, and no pairs are listed.

With 32 bands of 4, two documents at similarity 0.75 share no bucket once in 190,000 cases.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch, block_pairs
from duosync.llm.components import components

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
# Pairs whose signatures agree on less than this part are no links: a pair at similarity 0.75 falls
# below it in fewer than one of 10 ** 6 cases (binomial, 128 hashes).
LEAST_AGREEMENT = 0.55
# Members of a bucket that one task compares at a time.
BLOCK = 512
# Rounds over the bands in which buckets are gone through.
ROUNDS = 4
SEED = 20_240_229
REMEMBERED = 200_000


class Hashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = Hashes()


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text after lower-casing A-Z: runs without ASCII white space.

    On bytes both are what the methods do.
    """
    return text.lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, n: int = WORDS) -> np.ndarray:
    """The distinct shingles as sorted 64-bit numbers; a shorter text is one shingle as a whole."""
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    count = len(values) - n + 1
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + values[i : i + count])
    return np.unique(out)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the multiply-shift family."""
    draw = np.random.default_rng(SEED)
    a, b = draw.integers(0, 2**64, (2, HASHES), np.uint64)
    return a | np.uint64(1), b


_A, _B = _functions()


def signature(values: np.ndarray) -> np.ndarray:
    """Per hash function the smallest upper 32 bits of a * x + b over the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(values), 256):  # fits the cache, however long the text
        product = np.multiply.outer(values[part : part + 256], _A)
        product += _B
        np.minimum(least, product.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


SKETCH = "doc_id long, n_shingles long, digest binary, signature binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: dict[bytes, bytes] = {}
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            values = shingles(text.as_py())
            digest = xxhash.xxh3_128_digest(values.tobytes())
            if digest not in last:
                if len(last) >= 10_000:
                    last.clear()
                last[digest] = signature(values).tobytes()
            sizes.append(len(values))
            digests.append(digest if len(values) else None)
            signatures.append(last[digest] if len(values) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "n_shingles", "digest", "signature"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, band, node) for every band of every signature."""
    for batch in batches:
        matrix = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
        matrix = matrix.reshape(-1, BANDS, ROWS).astype(np.uint64)
        bucket = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(matrix), 1), np.uint64)
        for i in range(ROWS):
            bucket = _mix(bucket * np.uint64(0x9E3779B97F4A7C15) + matrix[:, :, i])
        node = np.repeat(batch.column(0).to_numpy(), BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(matrix))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket.reshape(-1).view(np.int64)), pa.array(band), pa.array(node)],
            ["bucket", "band", "node"],
        )


def _agree(a: bytes, b: bytes) -> bool:
    same = np.frombuffer(a, np.uint32) == np.frombuffer(b, np.uint32)
    return same.mean() >= LEAST_AGREEMENT


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, su, sv) whose signatures agree."""
    for batch in batches:
        keep = [
            _agree(a.as_py(), b.as_py())
            for a, b in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        raw = [shingles(text.as_py()).tobytes() for text in texts]
        digests = [xxhash.xxh3_128_digest(r) for r in raw]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
            ["node", "digest", "items"],
        )


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, for two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [
            linked(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64))
            for a, b in zip(batch.column(2), batch.column(3), strict=True)
        ]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


PAIR = "u long, v long"


def _confirmed(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Of pairs (u, v) of nodes those whose full sets are linked."""
    signed, sets = sets.select("node", "signature"), sets.select("node", "items")
    likely = scratch(
        pairs.join(signed.toDF("u", "su"), "u")
        .join(signed.toDF("v", "sv"), "v")
        .select("u", "v", "su", "sv")
        .mapInArrow(_likely, PAIR)
    )
    return scratch(
        likely.join(sets.toDF("u", "a"), "u")
        .join(sets.toDF("v", "b"), "v")
        .select("u", "v", "a", "b")
        .mapInArrow(_confirm, PAIR)
    )


def _across(key: tuple, rows: pa.Table) -> pa.Table:
    """Links of a block pair's members in different components, as far as they join components."""
    node, label = rows.column("node").to_numpy(), rows.column("component").to_numpy().copy()
    side, band = rows.column("side").to_numpy(), rows.column("band")[0].as_py()
    signed = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
    sets = [np.frombuffer(items.as_py(), np.uint64) for items in rows.column("items")]
    least, blocks, u, v = LEAST_AGREEMENT * HASHES, key[1].as_py() != key[2].as_py(), [], []
    for i in range(len(node) - 1):
        other = label[i + 1 :] != label[i]
        if blocks:
            other &= side[i + 1 :] != side[i]
        at = np.flatnonzero(other) + i + 1
        equal = signed[at] == signed[i]
        first = equal.reshape(len(at), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        for j in at[first & (np.count_nonzero(equal, axis=1) >= least)]:
            if label[j] != label[i] and linked(sets[i], sets[j]):
                u.append(node[i])
                v.append(node[j])
                label[label == label[j]] = label[i]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _remaining(members: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Links still missing: of (bucket, band, node, component) rows, across components.

    A bucket's members are dealt into blocks, and each pair of blocks is one group, so no task
    holds more than two blocks of a bucket. The bands are gone through in ``ROUNDS`` rounds: a
    node's set is sent to every group of the node, and only those of one round are on disk.
    """
    links = []
    for turn in range(ROUNDS):
        some = members.filter(F.col("band") % ROUNDS == turn)
        sizes = (
            some.groupBy("bucket")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
            .filter("low <> high")
            .select("bucket", "n")
        )
        sides = block_pairs(some, sizes, "bucket", "node", BLOCK, scratch).join(sets, "node")
        found = sides.groupBy("bucket", "i", "j").applyInArrow(_across, PAIR)
        links.append(scratch(found.distinct()))
    return reduce(DataFrame.unionByName, links)


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    A null text, or one without words, has an empty set and is linked with nothing. Rows that
    share an id but not a text are in one component. A row with a null id names no component:
    it joins that of an equal text, or else has a null component_id and is kept. An empty table gives no rows. Only ``doc_id`` and ``text`` are read; texts are taken whole.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketched = scratch(source.mapInArrow(_sketch, SKETCH))
    # One node per distinct set, named by its smallest document.
    nodes = scratch(
        sketched.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.max("signature").alias("signature"))
    )
    buckets = nodes.select("node", "signature").mapInArrow(
        _bands, "bucket long, band int, node long"
    )
    full = (
        buckets.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low < high")
        .select("bucket", "low")
    )
    members = scratch(buckets.join(scratch(full), "bucket"))
    stars = members.filter("node > low").select(F.col("low").alias("u"), F.col("node").alias("v"))
    asked = members.select("node").distinct()
    # The sets are made again from the texts of these documents only; of a node's texts the
    # one with its set counts, and repeated rows count once, before the shuffle.
    texts = source.join(asked.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    made = texts.mapInArrow(_sets, "node long, digest binary, items binary")
    sets = scratch(
        made.groupBy("node", "digest")
        .agg(F.first("items").alias("items"))
        .join(nodes, ["node", "digest"])
        .select("node", "signature", "items")
    )
    links = _confirmed(stars.distinct(), sets, scratch)
    found = scratch(components(links, scratch))
    placed = members.join(found, "node", "left").select(
        "bucket", "band", "node", F.coalesce("component", "node").alias("component")
    )
    more = _remaining(scratch(placed), sets, scratch)
    rows = scratch(
        sketched.select("doc_id", "n_shingles", "digest").join(
            nodes.select("digest", "node"), "digest", "left"
        )
    )
    # Rows that share an id but not a set.
    several = rows.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("w"))
    several = rows.join(scratch(several.filter("u < w")), "doc_id").select("u", F.col("node").alias("v"))
    edges = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
    edges = edges.unionByName(more).unionByName(several.distinct())
    return (
        rows.drop("digest")
        .join(components(edges, scratch), "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "node", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
