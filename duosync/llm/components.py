"""Connected components by alternating large-star and small-star steps.

Each step is one grouped minimum, built up before its shuffle, and one join, in which a hot
node's rows can be split among tasks; nobody ever holds a component or a node's whole neighbourhood.
Every step's edges are written to the shared folder, so a lost executor costs one step at most.
A step makes no more rows than twice its edges, so it writes as few files as those rows need: on a
folder of the local kind each file also costs the executor several started programs (``chmod``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

# Rows of a step in one file, about, and the files that even a small step may have.
FILE_ROWS = 1 << 16
FILES = 8


def _merged(step: DataFrame, edges: int) -> DataFrame:
    """A step over so many edges in as few partitions as its rows need, each a few of the others."""
    return step.coalesce(max(FILES, -(-2 * edges // FILE_ROWS)))


def _written(scratch: Scratch, edges: int, step: DataFrame) -> DataFrame:
    return scratch(_merged(step, edges))


# The minima are written before they are joined: a join of two plain shuffles is one whose hot
# partitions Spark splits, and with a known size the smaller side may be broadcast.


def _large_star(edges: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = write(down.groupBy("u").agg(F.min("v").alias("m")))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def _mark(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the smallest node reachable.

    Loops, repeats and edges with a null end are left out; a node without a proper edge has no
    row. The number of rounds grows with the logarithm of the nodes.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    edges = scratch(edges.filter("u <> v").distinct())
    before = _mark(edges)
    while before.n:
        write = partial(_written, scratch, before.n)
        edges = write(_small_star(write(_large_star(edges, write)), write))
        after = _mark(edges)
        if after == before:
            break
        before = after
    # Now every edge leads from a node to the smallest one of its component.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return _merged(found.unionByName(roots), before.n)
