"""Sharding by rendezvous hashing, in DataFrame expressions only.

Every shard i scores every key: ``-weight_i / ln(u)``, where u in (0, 1) comes from a 64-bit hash
of the key and i. The shard with the highest score owns the key, so a shard gets keys in
proportion to its weight, and adding a shard moves only the keys that the new one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch, row_chunks, slots


def score(key: Column, shard: int, weight: float) -> Column:
    """The score of one shard for a key."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    unit = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.lit(-float(weight)) / F.log(unit)


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard that owns a key: the highest score, on a tie the higher shard number.

    A null key is one key like any other. Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("at least one shard, and positive weights")
    bids = [F.struct(score(key, i, w), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    best = bids[0] if len(bids) == 1 else F.greatest(*bids)
    return best["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """Add the owning shard of ``key`` as column ``out``; the other columns stay as they are."""
    return df.withColumn(out, winner(F.col(key), weights))


def shard_documents(
    docs: DataFrame, scratch: Scratch, weights: Sequence[float], new_weight: float = 1.0
) -> DataFrame:
    """One row per document: size, text checksum, shard, slot in the shard, shard after growth.

    ``doc_id`` and the weights alone decide the shard, so equal ids share a shard, and with one
    shard more (of ``new_weight``) a document stays or moves into the new one. Slots count the
    rows of a shard from 0; repeated rows get a slot each. A null text has no bytes (size 8,
    checksum 0), a null id is a key of its own. An empty table gives no rows. Other columns of
    ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        winner(F.col("doc_id"), weights).alias("shard"),
        winner(F.col("doc_id"), [*weights, new_weight]).alias("grown_shard"),
    )
    return slots(scratch(row_chunks(rows)), "shard")


def moved(before: DataFrame, after: DataFrame, key: str, shard: str = "shard") -> DataFrame:
    """Keys whose shard differs between two assignments."""
    a = before.select(key, F.col(shard).alias("from_shard"))
    b = after.select(key, F.col(shard).alias("to_shard"))
    return a.join(b, key).filter("from_shard <> to_shard").distinct()
