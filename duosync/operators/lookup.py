"""Joins and lookups.

A lookup reduces the looked-up side to one row per key *before* it is joined. Neither a
popular key nor a repeated one can then multiply rows, and the reduction combines on the
map side. ``restrict`` first cuts the looked-up table to the keys of the batch, so that a
small batch does not shuffle a large table; ``wanted`` names the frame those keys come
from, where the events themselves are already a long plan. No join is forced to broadcast: the optimizer
does so from the sizes it measures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.operators.ordered import running


def _others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(keys)]


def join_reduced(ev: DataFrame, reduced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a frame with at most one row per key, whatever share of the events one key has.

    Events without a key match nothing and need not meet: a number made of the event spreads them. As it is one more
    join key, the reduced side is shuffled anew after its aggregate, and Spark can split the partition of a hot
    key, which it does only where plain shuffles lie under the join.
    """
    keys = list(keys)
    known = all_of([F.col(k).isNotNull() for k in keys])
    event = [c for c in ("event_id", "seq") if c in ev.columns] or ev.columns
    spread = F.when(known, F.lit(0).cast("long")).otherwise(F.xxhash64(*event))
    # Always 0, but not a literal, which would make the condition one of the events alone.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    joined = ev.withColumn("_spread", spread).join(
        reduced.withColumn("_spread", zero), [*keys, "_spread"], "left"
    )
    return joined.drop("_spread")


def inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "inner")


def restrict(fact: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``fact`` whose key occurs in ``wanted``."""
    keys = list(keys)
    return fact.join(wanted.select(*keys).distinct(), keys, "left_semi")


def semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left_semi")


def pick_one(
    fact: DataFrame, keys: Sequence[str], order: Sequence[Column], newest: bool
) -> DataFrame:
    """One row per key: the first or the last in ``order``.

    An aggregate instead of a window: it combines before the shuffle, so a key with very
    many rows costs its task one row per map task.
    """
    pick = F.max_by if newest else F.min_by
    rest = _others(fact, keys)
    chosen = fact.groupBy(*keys).agg(
        pick(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return chosen.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def enrich(
    ev: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``dim``, NULLs where it has no row.

    Of several rows with a key the first in ``order`` is taken, or the smallest without an
    order: a repeated key never multiplies events.
    """
    keys = list(keys)
    dim = restrict(dim, ev if wanted is None else wanted, keys)
    order = [F.struct(*_others(dim, keys))] if order is None else order
    return join_reduced(ev, pick_one(dim, keys, order, newest=False), keys)


def first_match(
    ev: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Any one matching row; we take the first in an explicit order."""
    return enrich(ev, dim, keys, order, wanted)


def latest(
    ev: DataFrame,
    fact: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    pred: Column | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """The newest matching fact per event; ``order`` sorts ascending, ties included."""
    keys = list(keys)
    if pred is not None:
        fact = fact.filter(pred)
    fact = restrict(fact, ev if wanted is None else wanted, keys)
    return join_reduced(ev, pick_one(fact, keys, order, newest=True), keys)


def same_day(c: Column | str) -> Column:
    """Day of a time, usable as a hash-join key."""
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def lookup_one(
    ev: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    found: str = "n_found",
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Left join of a dimension that should hold exactly one row per key.

    Adds ``found``, the number of matching rows (0 when none). The dimension's columns are
    filled only where it is 1. Pass the result to ``split_strict``.
    """
    keys = list(keys)
    rest = _others(dim, keys)
    # With one matching row the smallest struct is that row.
    counted = restrict(dim, ev if wanted is None else wanted, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias(found), F.min(F.struct(*rest)).alias("_row")
    )
    single = F.col(found) == 1
    out = join_reduced(ev, counted, keys).withColumns(
        {c: F.when(single, F.col(f"_row.{c}")) for c in rest}
    )
    return out.withColumn(found, F.coalesce(F.col(found), F.lit(0))).drop("_row")


def split_strict(
    df: DataFrame, found: str = "n_found"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(exactly one, missing, several) of a ``lookup_one`` result."""
    n = F.col(found)
    return df.filter(n == 1), df.filter(n == 0), df.filter(n > 1)


def exists_flag(
    ev: DataFrame, dim: DataFrame, keys: Sequence[str], flag: str = "exists"
) -> DataFrame:
    keys = list(keys)
    known = dim.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        join_reduced(ev, known, keys)
        .withColumn(flag, F.col("_hit").isNotNull())
        .drop("_hit")
    )


def find_or_create(
    ev: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    seq: str,
    make: Callable[[DataFrame], DataFrame],
    id_col: str = "id",
    needs: Sequence[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(events with ``id_col``, new dimension rows).

    Of the events whose key the dimension lacks, the first by ``seq`` makes the row:
    ``make`` gets those events, one per key, and returns the new rows. A key with a NULL
    matches nothing, so each such event makes its own row and stays without an id. ``needs`` names what
    ``make`` reads besides the keys and ``seq``, so that no more of the events is shuffled for it.
    """
    keys = list(keys)
    has_key = all_of([F.col(k).isNotNull() for k in keys])
    # The dimension is restricted and reduced once; who finds no id there is unknown to it.
    ids = restrict(dim.select(*keys, id_col), ev, keys).groupBy(*keys).agg(F.min(id_col).alias(id_col))
    known = join_reduced(ev, ids, keys)
    unknown = known.filter(F.col(id_col).isNull()).drop(id_col)
    if needs is not None:
        unknown = unknown.select(*keys, seq, *needs)
    makers = pick_one(unknown.filter(has_key), keys, [F.col(seq)], newest=False)
    new = make(makers.unionByName(unknown.filter(~has_key)))
    made = new.filter(has_key).select(*keys, F.col(id_col).alias("_made"))
    resolved = known.join(made, keys, "left").withColumn(
        id_col, F.coalesce(F.col(id_col), F.col("_made"))
    )
    return resolved.drop("_made"), new


def update_from(
    tgt: DataFrame, patch: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Set ``cols`` of the target rows that ``patch`` names. One patch row per key.

    Every patched column is taken from the patch, also when it is NULL there.
    """
    keys = list(keys)
    new = patch.select(*keys, F.struct(*cols).alias("_new"))
    hit = F.col("_new").isNotNull()
    set_cols = {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in cols}
    return tgt.join(new, keys, "left").withColumns(set_cols).select(*tgt.columns)


def enrich_as_of(
    ev: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    seq: str,
    cols: Sequence[str],
    *,
    inclusive: bool = False,
    width: int | None = None,
) -> DataFrame:
    """Each event sees the newest history row before it.

    Events and history are laid on one line per key and the last history row is carried
    forward, so no pairs are formed. ``inclusive`` also sees a history row of the same
    ``seq``. History ``seq`` values are unique per key.
    """
    keys, cols = list(keys), list(cols)
    rest = _others(ev, [*keys, seq])
    line = ev.select(
        *keys,
        seq,
        F.struct(*rest).alias("_ev"),
        F.lit(1 if inclusive else 0).alias("_side"),
        F.lit(None).cast(_struct_type(history, cols)).alias("_row"),
    ).unionByName(
        history.select(
            *keys,
            F.col(seq).cast(ev.schema[seq].dataType).alias(seq),
            F.lit(None).cast(_struct_type(ev, rest)).alias("_ev"),
            F.lit(0 if inclusive else 1).alias("_side"),
            F.struct(*cols).alias("_row"),
        )
    )
    seen = running(line, keys, seq, {"_seen": ("last", F.col("_row"))}, ties=["_side"], width=width)
    return seen.filter(F.col("_ev").isNotNull()).select(
        *keys,
        seq,
        *[F.col(f"_ev.{c}").alias(c) for c in rest],
        *[F.col(f"_seen.{c}").alias(c) for c in cols],
    )


def valid_ranges(versions: DataFrame, row_id: str, seq: str = "seq") -> DataFrame:
    """Versions of rows with ``_from``, their own ``seq``, and ``_to``, the one of the row's next
    version (NULL for the last): a version is what events after ``_from`` and up to ``_to`` see."""
    line = versions.withColumn("_from", F.col(seq)).withColumn("_back", -F.col(seq))
    return running(line, [row_id], "_back", {"_to": ("last", F.col("_from"))}).drop("_back")


def during(
    ev: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    seq: str,
    order: Sequence[Column],
    cols: Sequence[str],
    found: str = "n_found",
) -> DataFrame:
    """Each event sees the rows that are valid at its ``seq``: their number and the last one in ``order``.

    ``ranges`` has the keys, ``cols``, ``_from`` and ``_to`` as in ``valid_ranges``, and ``_n``, the
    number of rows it stands for. A row may come under another key in each version.

    A range is cut into the aligned blocks of 1, 2, 4, ... numbers that it fills, two of a size at most, and
    an event asks the one block of each size that its number lies in: every valid row is met in just one block.
    Blocks are summed up before the events ask, so no event meets a row, whatever a key's size.
    """
    keys, cols = list(keys), list(cols)
    span = ev.agg(F.min(seq).alias("low"), F.max(seq).alias("high")).first()
    low = span.low or 0
    bits = ((span.high or 0) - low + 1).bit_length()
    a = F.greatest(F.col("_from") + 1 - low, F.lit(0).cast("long"))
    b = F.least(F.coalesce(F.col("_to") + 1 - low, F.lit(1 << bits)), F.lit(1 << bits))
    blocks = f"""filter(flatten(transform(sequence(0, {bits}), l -> array(
        IF(_a_(l) < _b_(l) AND _a_(l) % 2 = 1, named_struct('size', l, 'at', _a_(l)), NULL),
        IF(_a_(l) < _b_(l) AND _b_(l) % 2 = 1, named_struct('size', l, 'at', _b_(l) - 1), NULL)
    ))), x -> x IS NOT NULL)"""
    blocks = blocks.replace("_a_(l)", "shiftright(_a + shiftleft(1L, l) - 1, l)")
    blocks = blocks.replace("_b_(l)", "shiftright(_b, l)")
    top = [F.sum("_n").alias("_n"), F.max_by("_row", "_order").alias("_row"), F.max("_order").alias("_order")]
    filled = (
        restrict(ranges, ev, keys)
        .select(*keys, "_n", F.struct(*cols).alias("_row"), F.struct(*order).alias("_order"), a.alias("_a"), b.alias("_b"))
        .filter("_a < _b")
        .withColumn("_block", F.explode(F.expr(blocks)))
        .groupBy(*keys, "_block")
        .agg(*top)
    )
    asked = restrict(ev.select(*keys, seq).distinct(), ranges, keys).withColumn(
        "_block",
        F.explode(
            F.expr(
                f"transform(sequence(0, {bits}), l -> "
                f"named_struct('size', l, 'at', shiftright({seq} - {low}L, l)))"
            )
        ),
    )
    seen = asked.join(filled, [*keys, "_block"]).groupBy(*keys, seq).agg(*top[:2])
    out = ev.join(seen, [*keys, seq], "left")
    return out.select(
        *ev.columns, F.coalesce("_n", F.lit(0)).alias(found), *[F.col(f"_row.{c}").alias(c) for c in cols]
    )


def _struct_type(df: DataFrame, cols: Sequence[str]):
    return df.select(F.struct(*cols).alias("s")).schema["s"].dataType


def all_of(conds: Sequence[Column]) -> Column:
    return reduce(and_, conds)


def any_of(conds: Sequence[Column]) -> Column:
    return reduce(or_, conds)
