"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. Equal vectors become one node, with the number of its rows.
2. On a bounded sample a rotation is learned that makes the signs of the principal components as
   close to the components themselves as it can (iterative quantisation). Several rotations from different
   starts give as many bits as the recall asks for. How often bits differ is measured on pairs at the
   threshold, made from the sample: centring widens their angles, the more the stronger the mean is.
3. A code is cut into substrings; each is the key of one hash table. Two vectors are candidates
   if a substring is equal and the whole codes' Hamming distance is small.
4. Candidates are compared by their cosine in double precision. No pair leaves a bucket: a task returns
   link counts per node and a spanning forest of the links it found. A pair that meets in
   several tables counts in the first one.

Buckets are dealt into blocks, so a task holds two blocks, however many vectors agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duosync.llm.common import Scratch, block_pairs
from duosync.llm.components import components

COSINE = 0.9
# Vectors the rotations are learned from, at most; every vector is indexed.
SAMPLE = 20_000
ITERATIONS = 50
# A bucket's mean number of vectors decides the substrings' length, the recall aimed at for a
# pair at the threshold decides how many substrings there are.
BUCKET, RECALL = 256, 0.98
# Sample vectors that pairs at the threshold are made of. From so many tables on, shorter substrings
# (so larger buckets) are taken if they are less work; recall stays.
PAIRS, MANY = 2_000, 64
BLOCK = 512
SEED = 7


class Codes:
    """Learned rotations; calling it gives a vector's substrings as small integers."""

    def __init__(self, sample: np.ndarray, vectors: int, cosine: float = COSINE):
        """``sample``: unit vectors in rows; ``vectors``: how many will be indexed."""
        dims = sample.shape[1]
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, ::-1][:, :64]
        width = axes.shape[1]
        draw = np.random.default_rng(SEED)
        pairs = self._pairs(sample, cosine)
        # A bit differs with the angle's part of a half turn, for a random hyperplane through the mean.
        differ = [self._angles((a - self.mean) @ axes, (b - self.mean) @ axes) / math.pi for a, b in pairs]
        differ = differ or [np.array([math.acos(cosine) / math.pi])]
        length = min(max(4, math.ceil(math.log2(max(vectors, 1) / BUCKET))), 30)
        found = {length: self._needed(differ, length)}
        if found[length] > MANY:
            found |= {x: self._needed(differ, x) for x in range(length)}
        # A row costs about as much as its comparison with a bucket.
        length = min(found, key=lambda x: found[x] * (BUCKET + vectors / 2**x))
        self.length, self.tables = length, found[length]
        bits = self.tables * length
        reduced = centred @ axes
        turns = [axes @ self._rotation(reduced, draw) for _ in range(math.ceil(bits / width))]
        self.planes = np.concatenate([*turns, np.empty((dims, 0))], axis=1)[:, :bits]
        # Four standard deviations above the mean distance of a pair at the threshold.
        apart = [np.bitwise_count(self(a) ^ self(b)).sum(axis=1) for a, b in pairs]
        apart = [math.ceil(x.mean() + 4 * x.std()) for x in apart]
        least = bits * math.acos(cosine) / math.pi
        least += 4 * math.sqrt(least * (1 - math.acos(cosine) / math.pi))
        self.radius = max([math.ceil(least), *apart])
        self.dims = dims

    @staticmethod
    def _pairs(sample: np.ndarray, cosine: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs of unit vectors at the cosine: sample vectors, and the same turned towards
        others of the sample, and towards anywhere."""
        draw, out = np.random.default_rng(SEED + 1), []
        a = sample[:PAIRS]
        for side in (sample[draw.permutation(len(sample))[: len(a)]], draw.standard_normal(a.shape)):
            side = side - (side * a).sum(axis=1, keepdims=True) * a
            size = np.linalg.norm(side, axis=1, keepdims=True)
            good = size[:, 0] > 1e-6
            if good.any():
                x = a[good]
                out.append((x, cosine * x + math.sqrt(max(0, 1 - cosine**2)) * side[good] / size[good]))
        return out

    @staticmethod
    def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Angles of rows; a right one for a row without a direction."""
        size = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
        return np.arccos(np.clip((a * b).sum(axis=1) / np.maximum(size, 1e-300), -1, 1))

    @staticmethod
    def _needed(differ: list[np.ndarray], length: int) -> float:
        """Tables that find ``RECALL`` of each kind of pairs, whose bits differ so often."""
        most = 0
        for kind in differ:
            apart = 1 - (1 - kind) ** length  # chance that a table misses a pair
            low, high = 0, 1
            while (apart**high).mean() > 1 - RECALL:
                low, high = high, 2 * high
                if high > 1 << 40:
                    return math.inf
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if (apart**middle).mean() > 1 - RECALL else (low, middle)
            most = max(most, high)
        return most

    @staticmethod
    def _rotation(data: np.ndarray, draw: np.random.Generator) -> np.ndarray:
        """Alternate between the nearest binary codes and the nearest rotation to them."""
        width = data.shape[1]
        turn, _ = np.linalg.qr(draw.standard_normal((width, width)))
        for _ in range(ITERATIONS):
            signs = np.where(data @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(data.T @ signs)
            turn = left @ right
        return turn

    def __call__(self, units: np.ndarray) -> np.ndarray:
        out = np.empty((len(units), self.tables), np.uint32)
        powers = 2.0 ** np.arange(self.length)
        step = max(1, (1 << 22) // max(1, self.tables * self.length))
        for at in range(0, len(units), step):
            bits = (units[at : at + step] - self.mean) @ self.planes >= 0
            out[at : at + step] = bits.reshape(len(bits), self.tables, self.length) @ powers
        return out


def _vectors(dtype: str):
    """(vec_id, digest, vector): valid vectors as bytes, null for the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for vector in batch.column(1):
                values = vector.values if vector.is_valid else None
                if values is None or not len(values) or values.null_count:
                    raw.append(None)
                    continue
                values = values.to_numpy().astype(dtype)
                sound = np.isfinite(values).all() and values.any()
                raw.append(values.tobytes() if sound else None)
            digests = [r and xxhash.xxh3_128_digest(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
                ["vec_id", "digest", "vector"],
            )

    return run


def _units(raw: list[bytes], dtype: str, dims: int) -> np.ndarray:
    """Unit vectors in rows, shorter ones filled up with zeros. Scaled first against overflow."""
    out = np.zeros((len(raw), dims))
    for row, r in zip(out, raw, strict=True):
        values = np.frombuffer(r, dtype)
        row[: len(values)] = values
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _tables(codes, dtype: str):
    """(bucket, node, rows, code, vector) for every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codes.value
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            found = code(_units(raw, dtype, code.dims))
            packed = pa.array([f.tobytes() for f in found], pa.binary())
            for t in range(code.tables):
                bucket = found[:, t].astype(np.int64) + (t << 32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket),
                        batch.column("node"),
                        batch.column("n"),
                        packed,
                        batch.column("vector"),
                    ],
                    ["bucket", "node", "rows", "code", "vector"],
                )

    return run


def forest(u: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
    """The smallest index reachable from each of ``size`` indexes over links u - v."""
    label = np.arange(size)
    while True:
        new = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(codes, dtype: str, cosine: float):
    """Per node of a block pair: links found here first, and a node it is linked with."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        code = codes.value
        table = int(key[0]) >> 32
        frame = frame.sort_values("node", ignore_index=True)
        size = len(frame)
        side = frame["side"].to_numpy()
        subs = np.frombuffer(b"".join(frame["code"]), np.uint32).reshape(size, -1)
        units = _units(list(frame["vector"]), dtype, code.dims)
        length = frame["vector"].map(len).to_numpy()
        us, vs = [], []
        for i in range(size - 1):
            rest = slice(i + 1, size)
            apart = np.bitwise_count(subs[rest] ^ subs[i]).sum(axis=1, dtype=np.int64)
            near = (apart <= code.radius) & (length[rest] == length[i])
            if key[1] != key[2]:
                near &= side[rest] != side[i]
            if table:
                near &= (subs[rest, :table] != subs[i, :table]).all(axis=1)
            hits = np.flatnonzero(near) + i + 1
            hits = hits[units[hits] @ units[i] >= cosine]
            if len(hits):
                us.append(np.full(len(hits), i))
                vs.append(hits)
        if not us:
            return pd.DataFrame({"node": [], "links": [], "to": []}).astype(np.int64)
        u, v = np.concatenate(us), np.concatenate(vs)
        n = frame["rows"].to_numpy()
        links = np.zeros(size, np.int64)
        np.add.at(links, u, n[v])
        np.add.at(links, v, n[u])
        node = frame["node"].to_numpy()
        out = pd.DataFrame({"node": node, "links": links, "to": node[forest(u, v, size)]})
        return out[links > 0]

    return run


def link_vectors(
    vectors: DataFrame,
    scratch: Scratch,
    column: str = "embedding",
    cosine: float = COSINE,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Vectors that are null, empty, zero or hold null or non-finite values have no links. Vectors
    of different lengths aren't linked. Every row is a vector of its own: equal rows are linked
    with each other, and ``n_links`` counts rows. A component without any id has a null
    component_id. An empty table gives no rows. Only ``vec_id`` and ``column`` are read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[column].dataType
    dtype = "<f4" if isinstance(kind.elementType, T.FloatType) else "<f8"
    source = vectors.select(
        F.col("vec_id").cast("long"),
        (F.col(column) if dtype == "<f4" else F.col(column).cast("array<double>")).alias("v"),
    )
    rows = scratch(
        source.mapInArrow(_vectors(dtype), "vec_id long, digest binary, vector binary")
    )
    valid = rows.filter("digest IS NOT NULL")
    distinct = valid.groupBy("digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    nodes = scratch(distinct.withColumn("node", F.monotonically_increasing_id()))
    total = nodes.agg(F.count("*"), F.max(F.length("vector"))).first()
    if total[0]:
        dims = total[1] // np.dtype(dtype).itemsize
        # By a share of the hash range: tasks send what they draw, ``sample`` vectors together on average.
        share = F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < int((1 << 40) * min(1, sample / total[0]))
        drawn = nodes.filter(share).select("vector").collect() or nodes.select("vector").head(1)
        learned = Codes(_units([r.vector for r in drawn], dtype, dims), total[0], cosine)
        codes = spark.sparkContext.broadcast(learned)
        dealt = scratch(
            nodes.select("node", "n", "vector").mapInArrow(
                _tables(codes, dtype),
                "bucket long, node long, rows long, code binary, vector binary",
            )
        )
        sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        found = scratch(
            block_pairs(dealt, sizes, "bucket", "node", BLOCK, scratch)
            .groupBy("bucket", "i", "j")
            .applyInPandas(_compare(codes, dtype, cosine), "node long, links long, to long")
        )
    else:
        found = scratch(spark.createDataFrame([], "node long, links long, to long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = components(found.select(F.col("node").alias("u"), F.col("to").alias("v")), scratch)
    known = scratch(
        nodes.select("digest", "node", "n", "least")
        .join(links, "node", "left")
        .join(placed, "node", "left")
        .select(
            "digest",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    names = scratch(known.groupBy("component").agg(F.min("least").alias("component_id")))
    named = known.join(names, "component").select("digest", "n_links", "component_id")
    return (
        rows.select("vec_id", "digest")
        .join(named, "digest", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("digest").isNull(), F.col("vec_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
