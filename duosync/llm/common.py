"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duosync.plans.lineage import Scratch

__all__ = ["Scratch", "block_pairs", "row_chunks", "slots", "table"]

# Rows of one input partition that are numbered together: 2 ** CHUNK_BITS.
CHUNK_BITS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_chunks(df: DataFrame) -> DataFrame:
    """Add ``_row``, unique per row, and ``_chunk``: runs of at most 65,536 rows of one partition.

    The numbers depend on the plan's partitions: write the result before reading it twice.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.withColumn("_chunk", F.shiftright("_row", CHUNK_BITS))


def slots(written: DataFrame, group: str, name: str = "slot") -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, as column ``name``.

    ``written`` has ``_row`` and ``_chunk`` and is read twice: once to count rows per group and
    chunk, once to number rows inside a chunk. No task sees more than a chunk's rows of a group,
    however large the group is; the running sum is over the chunk counts only. ``_row`` and
    ``_chunk`` are dropped.
    """
    counts = written.groupBy(group, "_chunk").agg(F.count("*").alias("_n"))
    before = counts.selectExpr(
        group,
        "_chunk",
        f"coalesce(sum(_n) OVER (PARTITION BY {group} ORDER BY _chunk"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
    )
    inside = written.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {group}, _chunk ORDER BY _row) - 1 AS _inside"
    )
    return (
        inside.join(before, [group, "_chunk"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_row", "_chunk", "_before", "_inside")
    )


def block_pairs(
    members: DataFrame, sizes: DataFrame, key: str, node: str, block: int, scratch: Scratch
) -> DataFrame:
    """Deal the members of each ``key`` into blocks, and give each pair of blocks its rows.

    ``sizes`` has (key, n). Adds ``i`` and ``j`` (i <= j), the pair of blocks a row is for, and
    ``side``: 0 for block i, 1 for block j (rows of a block with itself have side 0). Groups of
    (key, i, j) hold about two blocks, however many members a key has, and every two members
    meet in exactly one group. Members of keys that ``sizes`` leaves out go. The sizes are written
    first, so Spark can split a hot key's partition in the join, or broadcast the small side.
    """
    counted = scratch(sizes.select(key, F.ceil(F.col("n") / block).cast("int").alias("_blocks")))
    at = (
        "transform(sequence(0, _blocks - 1), o -> named_struct("
        "'i', least(o, _b), 'j', greatest(o, _b), 'side', IF(_b > o, 1, 0)))"
    )
    return (
        members.join(counted, key)
        .withColumn("_b", F.expr(f"CAST(pmod(xxhash64({node}), _blocks) AS INT)"))
        .withColumn("_at", F.explode(F.expr(at)))
        .select("*", "_at.i", "_at.j", "_at.side")
        .drop("_blocks", "_b", "_at")
    )
