"""Reject and trace rows of the shared log.

A reject says why an event was not applied; a trace is written on a normal path. Both
keep the status the log has always used, so ``kind`` tells them apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.functions import codes
from duosync.functions.columns import text

LEGACY_TO_MODERN = ("LEGACY", "MODERN")
MODERN_TO_LEGACY = ("MODERN", "LEGACY")

# Columns written as an empty text by the systems, which they store as NULL.
_NEVER_SET = ("updated_by", "updated_timestamp", "trigger_input")


def _log(
    df: DataFrame,
    kind: str,
    source: str,
    direction: tuple[str, str],
    table_id: Column,
    reason: Column | str,
    now: Column,
    status: str,
    failure_count: int,
    created_by: str,
) -> DataFrame:
    name, table, _ = codes.LOG_SOURCES[source]
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(
        "event_id",
        F.lit(kind).alias("kind"),
        F.lit(name).alias("trigger_name"),
        F.lit(table).alias("table_name"),
        table_id.alias("table_id"),
        F.lit(direction[0]).alias("source_system"),
        F.lit(direction[1]).alias("destination_system"),
        F.lit(status).alias("status"),
        why.alias("failure_reason"),
        F.lit(failure_count).cast("int").alias("failure_count"),
        F.lit(created_by).alias("created_by"),
        now.alias("created_timestamp"),
        F.lit(None).cast("string").alias(_NEVER_SET[0]),
        F.lit(None).cast("timestamp").alias(_NEVER_SET[1]),
        F.lit(codes.LOG_DOMAIN).alias("domain"),
        F.lit(None).cast("string").alias(_NEVER_SET[2]),
    )


def prefixed_id(source: str, value: Column) -> Column:
    return text(codes.LOG_SOURCES[source][2], value)


def rejects(
    df: DataFrame,
    source: str,
    direction: tuple[str, str],
    table_id: Column,
    reason: Column | str,
    now: Column,
    failure_count: int = 0,
) -> DataFrame:
    """One log row per rejected event, with a reason code."""
    return _log(
        df, "reject", source, direction, table_id, reason, now, "FAILED", failure_count,
        codes.LOG_CREATED_BY,
    )


def trace(
    df: DataFrame,
    source: str,
    direction: tuple[str, str],
    table_id: Column,
    reason: Column | str,
    now: Column,
    *,
    status: str = "FAILED",
    failure_count: int = 0,
    created_by: str = codes.LOG_CREATED_BY,
) -> DataFrame:
    """One log row on a normal path."""
    return _log(
        df, "trace", source, direction, table_id, reason, now, status, failure_count, created_by
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
