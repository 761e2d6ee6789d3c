"""Folding many changes into one patch per key, and merging patches into a snapshot.

Change events apply one after another, each setting some columns and maybe inserting the
row. ``fold_patches`` reproduces the outcome with a single aggregate per key, so that the
merge joins at most one patch row to each target row.

A *patch* row has the key columns, ``seq``, ``event_id``, the value columns, and two bit
masks over the target's columns: ``update_mask`` says which columns the event sets on a
present row, ``insert_mask`` which ones it fills when it inserts (NULL when it may not).
Columns that every kind of event sets together form a *group*. A group is folded as one
value, and the target keeps the ``seq`` of its last writer, so that late or repeated
patches lose.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.operators.lookup import all_of
from duosync.operators.ordered import running

UNSET_SEQ = -1


@dataclass(frozen=True)
class PatchShape:
    """Key columns, value columns and the column sets that events use together."""

    keys: tuple[str, ...]
    columns: tuple[str, ...]
    sets: tuple[tuple[str, ...], ...]
    types: tuple[str, ...]

    def mask(self, cols: Sequence[str] | None) -> Column:
        """Bit mask of a column set as a literal; NULL for None."""
        if cols is None:
            return F.lit(None).cast("long")
        unknown = set(cols) - set(self.columns)
        if unknown:
            raise ValueError(f"not value columns: {sorted(unknown)}")
        return F.lit(sum(1 << self.columns.index(c) for c in cols)).cast("long")

    def groups(self) -> list[tuple[str, ...]]:
        """Columns with the same membership in every set."""
        found: dict[tuple[bool, ...], list[str]] = {}
        for c in self.columns:
            found.setdefault(tuple(c in s for s in self.sets), []).append(c)
        return [tuple(g) for g in found.values()]

    def bit(self, col: str) -> int:
        return 1 << self.columns.index(col)

    def seq_columns(self) -> list[str]:
        return [f"_seq_{i}" for i in range(len(self.groups()))]


def with_masks(
    df: DataFrame,
    shape: PatchShape,
    update_cols: Sequence[str],
    insert_cols: Sequence[str] | None,
) -> DataFrame:
    """Shape a DataFrame of new values into patch rows; absent value columns become NULL."""
    have = set(df.columns)
    return df.select(
        *shape.keys,
        "seq",
        "event_id",
        *[
            (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
            for c, t in zip(shape.columns, shape.types, strict=True)
        ],
        shape.mask(update_cols).alias("update_mask"),
        shape.mask(insert_cols).alias("insert_mask"),
    )


def has_full_key(shape: PatchShape) -> Column:
    return all_of([F.col(k).isNotNull() for k in shape.keys])


def fold_patches(patches: DataFrame, shape: PatchShape) -> DataFrame:
    """One row per key: the last update of each group, and the first inserting event.

    Rows with a NULL in the key match nothing and must not be folded; see ``apply_patches``.
    """
    aggs = []
    for i, group in enumerate(shape.groups()):
        sets = F.col("update_mask").bitwiseAND(shape.bit(group[0])) != 0
        aggs.append(F.max(F.when(sets, F.struct("seq", *group))).alias(f"u_{i}"))
    first = F.struct("seq", "event_id", "insert_mask", *shape.columns)
    aggs.append(F.min(F.when(F.col("insert_mask").isNotNull(), first)).alias("first_insert"))
    return patches.groupBy(*shape.keys).agg(*aggs)


def with_bookkeeping(tgt: DataFrame, shape: PatchShape) -> DataFrame:
    """Add the bookkeeping columns to a plain snapshot."""
    have = set(tgt.columns)
    add = {c: F.lit(UNSET_SEQ).cast("long") for c in shape.seq_columns() if c not in have}
    if "_event_id" not in have:
        add["_event_id"] = F.lit(None).cast("string")
    return tgt.withColumns(add) if add else tgt


def apply_patches(
    tgt: DataFrame, patches: DataFrame, shape: PatchShape, *, strict_keys: bool = False
) -> DataFrame:
    """Merge patches into a snapshot as if they had been applied one by one in ``seq`` order.

    For a key the target lacks, events before the first inserting one do nothing, that one
    fills its insert columns, and later ones set their update columns. Inserting patches
    with a NULL in the key add a row each, unless ``strict_keys`` leaves them out (the
    caller then rejects them).
    """
    tgt = with_bookkeeping(tgt, shape)
    keyed = patches.filter(has_full_key(shape))
    # Both sides keep their keys, so the names must differ.
    folded = fold_patches(keyed, shape).select(
        *[F.col(k).alias(f"_p_{k}") for k in shape.keys],
        *[f"u_{i}" for i in range(len(shape.groups()))],
        "first_insert",
    )
    present = F.col("_present").isNotNull()
    joined = tgt.withColumn("_present", F.lit(True)).join(
        folded, [F.col(k) == F.col(f"_p_{k}") for k in shape.keys], "full_outer"
    )
    first = F.col("first_insert")
    joined = joined.filter(present | first.isNotNull())

    out = {k: F.coalesce(F.col(k), F.col(f"_p_{k}")) for k in shape.keys}
    for i, group in enumerate(shape.groups()):
        upd, stored = F.col(f"u_{i}"), F.col(f"_seq_{i}")
        newer = F.coalesce(upd["seq"] > F.coalesce(stored, F.lit(UNSET_SEQ)), F.lit(False))
        after_insert = F.coalesce(upd["seq"] > first["seq"], F.lit(False))
        for c in group:
            filled = F.when(first["insert_mask"].bitwiseAND(shape.bit(c)) != 0, first[c])
            out[c] = F.when(present, F.when(newer, upd[c]).otherwise(F.col(c))).otherwise(
                F.when(after_insert, upd[c]).otherwise(filled)
            )
        out[f"_seq_{i}"] = F.when(
            present, F.when(newer, upd["seq"]).otherwise(stored)
        ).otherwise(F.when(after_insert, upd["seq"]).otherwise(first["seq"]))
    out["_event_id"] = F.when(present, F.col("_event_id")).otherwise(first["event_id"])
    merged = joined.select(
        *[out[c].alias(c) if c in out else F.col(c) for c in tgt.columns]
    )
    if strict_keys:
        return merged
    return merged.unionByName(_keyless_rows(tgt, patches, shape))


def _keyless_rows(tgt: DataFrame, patches: DataFrame, shape: PatchShape) -> DataFrame:
    """One new row per inserting patch with a NULL in its key, once per event."""
    rows = keyless_inserts(patches, shape)
    known = tgt.filter(~has_full_key(shape)).select("_event_id")
    rows = rows.join(known, rows["event_id"] == known["_event_id"], "left_anti")
    values = {
        c: F.when(F.col("insert_mask").bitwiseAND(shape.bit(c)) != 0, F.col(c))
        for c in shape.columns
    }
    extra = {s: F.col("seq") for s in shape.seq_columns()}
    extra["_event_id"] = F.col("event_id")
    have = {**{k: F.col(k) for k in shape.keys}, **values, **extra}
    return rows.select(*[have[c].alias(c) for c in tgt.columns])


def keyless_inserts(patches: DataFrame, shape: PatchShape) -> DataFrame:
    return patches.filter(~has_full_key(shape) & F.col("insert_mask").isNotNull())


def merge_upsert(
    tgt: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str],
) -> DataFrame:
    """Update matched rows and insert the others. One source row per key.

    ``insert_cols`` name the value columns filled on insert; the rest start NULL. NULL keys
    match nothing, so such source rows insert and such target rows stay.
    """
    keys = list(keys)
    src_cols = [c for c in src.columns if c not in keys]
    right = src.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*src_cols, F.lit(1)).alias("_s")
    )
    left = tgt.withColumn("_present", F.lit(True))
    joined = left.join(right, [F.col(k) == F.col(f"_s_{k}") for k in keys], "full_outer")
    present, matched = F.col("_present").isNotNull(), F.col("_s").isNotNull()
    out = []
    for c in tgt.columns:
        if c in keys:
            new = F.when(present, F.col(c)).otherwise(F.col(f"_s_{c}"))
        else:
            kept = F.when(matched, F.col(f"_s.{c}")).otherwise(F.col(c)) if c in update_cols else F.col(c)
            fresh = F.col(f"_s.{c}") if c in insert_cols else F.lit(None)
            new = F.when(present, kept).otherwise(fresh)
        out.append(new.alias(c))
    return joined.select(*out)


def merge_delete(
    tgt: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    stamp_cols: Sequence[str],
    insert_cols: Sequence[str] | None,
    *,
    status: str = "result",
    inactive: str = "INACTIVE",
) -> DataFrame:
    """Soft delete: mark matched rows INACTIVE with their stamps.

    With ``insert_cols`` an unmatched source row leaves a tombstone; without them nothing.
    """
    src = src.withColumn(status, F.lit(inactive))
    if insert_cols is None:
        src = src.join(tgt.select(*keys), list(keys), "left_semi")
    return merge_upsert(
        tgt, src, keys, [status, *stamp_cols], [status, *(insert_cols or [])]
    )


def compare_and_set(
    ev: DataFrame,
    keys: Sequence[str],
    seq: str,
    stored: Column,
    value: Column,
    *,
    width: int | None = None,
) -> DataFrame:
    """The events whose guarded write ("only where the column is still NULL") takes effect.

    ``keys`` name the cell and the last unguarded write to it before the event, ``stored`` is what that write
    left there. Where it left a value, no write takes effect. Else they all do up to the first one that sets
    a value: a write of NULL leaves the cell open. An unguarded write starts over, so the outcome is that of
    applying all writes one by one.
    """
    open_ = ev.filter(stored.isNull())
    tried = running(open_, keys, seq, {"_set": ("count", value.isNotNull())}, width=width)
    return tried.filter("_set = 0").drop("_set")


def one_primary(
    accounts: DataFrame,
    promotions: DataFrame,
    *,
    customer: str = "customer_id",
    account: str = "account_id",
    born: str = "born_seq",
    flag: str = "is_primary",
) -> DataFrame:
    """Leave one primary account per promoted customer.

    ``promotions`` holds valid promotions as (customer, account, seq). The last one wins and
    clears the flag of the customer's other accounts, except those born after it, which keep
    their own. The promoting event may itself open the promoted account. ``accounts`` are the live ones; ``born_seq`` is -1 for stored accounts.
    """
    last = promotions.groupBy(customer).agg(
        F.max(F.struct(F.col("seq"), F.col(account).alias("winner"))).alias("_last")
    )
    is_winner = F.col(account) == F.col("_last.winner")
    opened_by_it = is_winner & (F.col(born) == F.col("_last.seq"))
    decided = F.col("_last").isNotNull() & ((F.col(born) < F.col("_last.seq")) | opened_by_it)
    wins = F.when(is_winner, 1).otherwise(0)
    return (
        accounts.join(last, [customer], "left")
        .withColumn(flag, F.when(decided, wins).otherwise(F.col(flag)).cast("int"))
        .select(*accounts.columns)
    )


def valid_promotions(
    promotions: DataFrame,
    lifetimes: DataFrame,
    *,
    customer: str = "customer_id",
    account: str = "account_id",
    width: int | None = None,
) -> DataFrame:
    """Promotions whose account is alive when they happen.

    ``lifetimes`` holds (customer, account, seq, alive) for every insert and delete; stored
    accounts are inserts at seq -1.
    """
    line = promotions.select(
        customer, account, "seq", F.lit(None).cast("boolean").alias("alive")
    ).unionByName(lifetimes.select(customer, account, "seq", "alive"))
    seen = running(
        line, [customer, account], "seq", {"_alive": ("last", F.col("alive"))}, width=width
    )
    return seen.filter(F.col("alive").isNull() & F.col("_alive")).select(customer, account, "seq")
