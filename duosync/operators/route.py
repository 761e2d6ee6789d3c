"""Change predicates and routing of events to branches.

Predicates follow SQL: a comparison with NULL is unknown, and ``filter`` drops unknown
rows. Where a stream is split in two, the unknown rows go to the ``else`` side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.functions import codes

MODERN = "MODERN"
LEGACY = "LEGACY"
CASH = codes.CHANNEL_CODES["AGENT"]


def is_true(cond: Column) -> Column:
    """The condition with unknown turned into false."""
    return F.coalesce(cond, F.lit(False))


def touching(ev: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Events that insert or delete, or whose update names one of ``cols``.

    A named column counts even if its value stays the same. Where the feed does not carry
    ``updated_cols``, a null-safe difference of the images decides.
    """
    differs = reduce(or_, [~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in cols])
    if "updated_cols" in ev.columns:
        named = F.arrays_overlap(F.col("updated_cols"), F.array(*[F.lit(c) for c in cols]))
        hit = F.when(F.col("updated_cols").isNull(), differs).otherwise(named)
    else:
        hit = differs
    return ev.filter((F.col("op") != "U") | hit)


def has_changed(cols: Sequence[str]) -> Column:
    """Some column differs between the images; NULL on either side counts as unchanged."""
    return reduce(or_, [F.col(f"before.{c}") != F.col(f"after.{c}") for c in cols])


def changed(ev: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ev.filter((F.col("op") == "U") & has_changed(cols))


def went(col: str, frm, to) -> Column:
    return (F.col(f"before.{col}") == frm) & (F.col(f"after.{col}") == to)


def transition(ev: DataFrame, col: str, frm, to) -> DataFrame:
    """Updates that move ``col`` from exactly ``frm`` to exactly ``to``."""
    return ev.filter((F.col("op") == "U") & went(col, frm, to))


def flag_branches(ev: DataFrame, branches: dict[str, Column]) -> DataFrame:
    """Add one boolean per branch. An event may satisfy several; unknown is false."""
    return ev.withColumns({name: is_true(cond) for name, cond in branches.items()})


def not_migrated(is_migrated: Column | str) -> Column:
    """True for rows that belong to the legacy side; NULL is not among them."""
    c = F.col(is_migrated) if isinstance(is_migrated, str) else is_migrated
    return is_true(c != codes.MIGRATED)


def not_echo(origin: Column | str = "origin") -> Column:
    """True unless the change came from the modern side; an unset origin is legacy."""
    c = F.col(origin) if isinstance(origin, str) else origin
    return F.coalesce(c, F.lit(LEGACY)) != MODERN


def drop_echo(ev: DataFrame) -> DataFrame:
    """Drop changes that came from modern. Use it on the migrated side only."""
    return ev.filter(not_echo())


def not_sentinel(channel: Column | str = "channel") -> Column:
    """True for a channel that is known and not the cash channel."""
    c = F.col(channel) if isinstance(channel, str) else channel
    return is_true(c != CASH)


def drop_sentinel(ev: DataFrame, channel: Column | str = "channel") -> DataFrame:
    """Drop attempts of the cash channel, and those without one."""
    return ev.filter(not_sentinel(channel))
