"""Running values along an ordered key, safe when one key holds most of the rows.

A plain window sorts all rows of a key in one task. Here each key is first cut into
chunks of its order column. Inside a chunk a window computes the running value; the
chunks of a key are summarised by a partial aggregate, and a second, small window over
those summaries gives each chunk what came before it. A hot key is so spread over as
many tasks as it has chunks, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_WIDTH = 1 << 20
DEFAULT_TIME_WIDTH = 7 * 24 * 3600 * 1_000_000


def chunk_of(df: DataFrame, order: str, width: int | None = None) -> Column:
    """Chunk number of the order column: ``width`` counts units, or microseconds for times."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value, default = F.unix_micros(F.col(order).cast("timestamp")), DEFAULT_TIME_WIDTH
    else:
        value, default = F.col(order).cast("long"), DEFAULT_WIDTH
    size = width or default
    return F.floor(value / F.lit(size)).cast("long")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: dict[str, tuple[str, Column | None]],
    *,
    ties: Sequence[str] = (),
    width: int | None = None,
) -> DataFrame:
    """Add running values over the rows *before* each row of the same key.

    ``values`` maps a new column to ``("count", condition)``, ``("sum", value)``,
    ``("last", value)`` or ``("max", value)``. ``count`` counts rows whose condition holds (all rows for
    None) and is 0 at first, as is ``sum``; ``last`` and ``max`` skip NULL values. Rows with equal
    ``order`` are told apart by ``ties``.
    """
    keys = list(keys)
    sort = [F.col(order)] + [F.col(t) for t in ties]
    at = F.struct(*sort)
    df = df.withColumn("_chunk", chunk_of(df, order, width))
    for name, (kind, value) in values.items():
        cond = F.lit(True) if value is None else value
        source = F.when(cond, F.lit(1)) if kind == "count" else value
        df = df.withColumn(f"_v_{name}", source)

    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*sort)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    in_chunk, totals, carries, merged = {}, [], {}, {}
    for name, (kind, _) in values.items():
        v, own, total, carry = F.col(f"_v_{name}"), f"_own_{name}", f"_tot_{name}", f"_pre_{name}"
        if kind == "count":
            in_chunk[own] = F.count(v).over(inside)
            totals.append(F.count(v).alias(total))
            carries[carry] = F.sum(total).over(before)
            merged[name] = F.col(own) + F.coalesce(F.col(carry), F.lit(0))
        elif kind == "sum":
            in_chunk[own] = F.sum(v).over(inside)
            totals.append(F.sum(v).alias(total))
            carries[carry] = F.sum(total).over(before)
            merged[name] = F.coalesce(F.col(own), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
        elif kind == "last":
            in_chunk[own] = F.last(v, ignorenulls=True).over(inside)
            totals.append(F.max_by(v, F.when(v.isNotNull(), at)).alias(total))
            carries[carry] = F.last(total, ignorenulls=True).over(before)
            merged[name] = F.coalesce(F.col(own), F.col(carry))
        elif kind == "max":
            in_chunk[own] = F.max(v).over(inside)
            totals.append(F.max(v).alias(total))
            carries[carry] = F.max(total).over(before)
            merged[name] = F.greatest(F.col(own), F.col(carry))
        else:
            raise ValueError(f"unknown running value: {kind}")

    # The summary's key columns are renamed and joined with plain equality in the order the
    # window partitions by, so the rows keep their partitioning. A NULL key equals nothing
    # and so has nothing before it.
    summary = df.groupBy(*keys, "_chunk").agg(*totals).withColumns(carries)
    summary = summary.select(
        *[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_k_chunk"),
        *carries,
    )
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    on = [F.col(k) == F.col(f"_k_{i}") for i, k in enumerate(keys)]
    on.append(F.col("_chunk") == F.col("_k_chunk"))
    for name, (kind, _) in values.items():
        nothing = F.lit(0) if kind in ("count", "sum") else F.lit(None)
        merged[name] = F.when(known, merged[name]).otherwise(nothing)
    out = df.withColumns(in_chunk).join(summary, on, "left").withColumns(merged)
    helpers = [c for c in out.columns if c.startswith(("_v_", "_own_", "_pre_", "_k_"))]
    return out.drop("_chunk", *helpers)
