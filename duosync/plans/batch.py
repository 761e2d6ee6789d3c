"""One batch over all feeds.

The modern-side flows run first. What they change on the legacy side becomes, marked MODERN,
part of the legacy feeds. The legacy-side flows write only the target, so two stages are
enough. Attempt counts, locks, existence, primary flags and the target follow the events one by
one, and so do the images and patches of a source row. Both stages look verifications up as they are
before each event, the second one staging rows, transactions and accounts, too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duosync.functions.columns import CHANGE_OFFSET_MICROS, debit_amount
from duosync.operators.generate import MOST_SEQ, born
from duosync.operators.lookup import update_from
from duosync.operators.merge import apply_patches
from duosync.operators.rejects import (
    LEGACY_TO_MODERN,
    MODERN_TO_LEGACY,
    prefixed_id,
    rejects,
    union_all,
)
from duosync.plans import legacy_side as legacy
from duosync.plans import modern_side as modern
from duosync.plans.lineage import Scratch
from duosync.plans.target import KEYS, SHAPE
from duosync.plans.versions import FIRST, VERSIONS
from duosync.sources.schemas import (
    ACCOUNT_RESULT,
    APPLIED,
    DEPOSIT_RESULT,
    FEEDS,
    MONEY,
    TABLES,
    envelope,
    schema,
)

Tables = dict[str, DataFrame]
BAD_EVENT = "EVENT_WITHOUT_ID_OR_NUMBER"
BAD_AMOUNT, BAD_TIME = "AMOUNT_OUT_OF_RANGE", "TIME_OUT_OF_RANGE"

# A batch replaces all rows with a touched key value; the key is also the bucket key.
REPLACE_KEYS: dict[str, tuple[str, ...]] = {
    "modern_account": ("stage_sequence_id",),
    "modern_deposit": ("stage_sequence_id",),
    "customer_account": ("customer_id",),
    "verification": ("bank_account_verification_id",),
    "attempt": ("id",),
    "transaction": ("bank_account_verification_id",),
    "bank_account": ("id",),
    "user": ("id",),
    "lock": ("id",),
    "deposit_verification": ("bank_account_verification_id",),
    "id_map": ("modern_bank_account_id",),
    "applied": ("row_id",),
    "target": KEYS,
}

# Row id of each source table, by which feed images are applied.
ROW_IDS = {
    "modern_account": "stage_sequence_id",
    "modern_deposit": "stage_sequence_id",
    "customer_account": "customer_bank_account_id",
    "verification": "bank_account_verification_id",
    "attempt": "id",
    "transaction": "id",
}


@dataclass
class BatchResult:
    """``outputs`` are rows to append; ``tables`` the state after the batch; ``touched`` the
    key values whose rows changed; ``patches`` what was merged into the target."""

    outputs: dict[str, DataFrame]
    tables: Tables
    touched: dict[str, DataFrame]
    patches: DataFrame
    release: Callable[[], None] = lambda: None


def empty(spark: SparkSession, kind: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer knows to have none: joins and unions with it go from the plan.

    Of an empty list it knows no size, and sorts and shuffles all that is joined with it.
    """
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]
    return spark.range(0).filter(F.lit(False)).select(*columns)


def with_empty_feeds(spark: SparkSession, feeds: Tables) -> Tables:
    """The feeds, with an empty one for each that is absent."""
    absent = {n: envelope(ddl) for n, ddl in FEEDS.items() if n not in feeds}
    return {**feeds, **{n: empty(spark, s) for n, s in absent.items()}}


def with_empty_tables(spark: SparkSession, tables: Tables) -> Tables:
    """The tables, with an empty one for each that is absent."""
    absent = {n: schema(ddl) for n, ddl in TABLES.items() if n not in tables}
    return {**tables, **{n: empty(spark, s) for n, s in absent.items()}}


def latest_images(feed: DataFrame, row_id: str) -> DataFrame:
    """Last change per row: (row id, image), with a NULL image for a deleted row."""
    key = F.coalesce(F.col(f"after.{row_id}"), F.col(f"before.{row_id}"))
    last = feed.groupBy(key.alias("_id")).agg(
        F.max_by(F.struct("op", "after"), F.col("seq")).alias("_last")
    )
    return last.select(
        "_id", F.when(F.col("_last.op") != "D", F.col("_last.after")).alias("_image")
    )


def unsound(feed: DataFrame) -> DataFrame:
    """Events without an id, or without a number that ids can be made from, and those whose values
    could not be read (``feeds.typed_changes``)."""
    seq = F.col("seq")
    return feed.filter(
        F.col("event_id").isNull() | seq.isNull() | (seq < 0) | (seq > MOST_SEQ) | error_of(feed).isNotNull()
    )


def sound(feed: DataFrame) -> DataFrame:
    good = feed.filter(error_of(feed).isNull()).drop("error")
    return good.filter(F.col("event_id").isNotNull() & F.col("seq").between(0, MOST_SEQ))


def error_of(feed: DataFrame) -> Column:
    return F.col("error") if "error" in feed.columns else F.lit(None).cast("string")


def failures() -> dict[str, Column]:
    """Per feed, why an event that its flow computes with would end in an error; NULL for all others.

    Its flow leaves such an event out. Its image is stored, as the systems keep the row.
    """
    amounts = [F.col("after.mdamount1"), F.col("after.mdamount2")]
    debit = debit_amount(*amounts)
    later = F.try_add(F.col("after.created_timestamp"), F.expr(f"INTERVAL '{CHANGE_OFFSET_MICROS}' MICROSECOND"))
    late = F.col("after.created_timestamp").isNotNull() & later.isNull()
    return {
        "modern_deposit": F.when(
            (F.col("op") == "I") & debit.isNotNull() & debit.try_cast(MONEY).isNull(), BAD_AMOUNT
        ),
        "modern_account": F.when((F.col("op") == "I") & late, BAD_TIME),
    }


def _row_id(name: str) -> Column:
    key = ROW_IDS[name]
    return F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))


def unsound_rejects(feeds: Tables, now: Column) -> list[DataFrame]:
    """Log rows for the events that take no part."""
    return [
        rejects(
            unsound(feed), name, MODERN_TO_LEGACY if name.startswith("modern") else LEGACY_TO_MODERN,
            prefixed_id(name, _row_id(name)), F.coalesce(error_of(feed), F.lit(BAD_EVENT)), now,
        )
        for name, feed in feeds.items()
    ]


def failed_rejects(feed: DataFrame, name: str, why: Column, now: Column) -> DataFrame:
    """Log rows for the events that their flow can't compute with."""
    return rejects(
        feed.filter(why.isNotNull()), name, MODERN_TO_LEGACY, prefixed_id(name, _row_id(name)), why, now
    )


def newer_images(feed: DataFrame, name: str, applied: DataFrame) -> DataFrame:
    """Events that come after the last one whose image the row has already taken."""
    done = applied.filter(F.col("feed") == name).select(
        F.col("row_id").alias("_row_id"), F.col("seq").alias("_done")
    )
    out = feed.withColumn("_row_id", _row_id(name)).join(done, ["_row_id"], "left")
    return out.filter(F.col("_done").isNull() | (F.col("seq") > F.col("_done"))).select(*feed.columns)


def taken_images(feed: DataFrame, name: str) -> DataFrame:
    """(feed, row_id, seq) of the last event of each row."""
    return (
        feed.groupBy(_row_id(name).alias("row_id"))
        .agg(F.max("seq").alias("seq"))
        .select(F.lit(name).alias("feed"), "row_id", "seq")
    )


def apply_images(table: DataFrame, feed: DataFrame, row_id: str) -> DataFrame:
    """A table after a feed of full images."""
    cols = table.columns
    images = latest_images(feed, row_id)
    kept = table.join(images, table[row_id] == images["_id"], "left_anti")
    fresh = images.filter(F.col("_image").isNotNull()).select(
        *[F.col(f"_image.{c}").alias(c) for c in cols]
    )
    return kept.unionByName(fresh)


def _keys(frames: list[DataFrame], *cols: str) -> DataFrame:
    return union_all([f.select(*cols) for f in frames]).distinct()


def run_batch(
    feeds: Tables,
    tables: Tables,
    now: Column,
    *,
    mask: bool = True,
    strict_keys: bool = False,
    fix_exists: bool = False,
) -> BatchResult:
    """Apply all feeds to the tables.

    ``feeds`` may leave out feeds without events. Events without an id or with a number out of
    range are rejected, as are those with an ``error``, and those whose amounts or times leave their
    types' range; each gives one log row, and all others go on. A source row takes an event's image only if that is the newest one it
    has seen: the table ``applied`` says so, also for deleted rows and for earlier batches. Frames that several outputs are cut from
    are written to the checkpoint folder; ``release`` of the result deletes them.
    """
    spark = tables["target"].sparkSession
    given = set(feeds)
    bad = unsound_rejects(feeds, now)
    feeds = with_empty_feeds(spark, {n: sound(f) for n, f in feeds.items()})
    keep = Scratch(spark)

    start = with_empty_tables(spark, tables)
    t = dict(start)
    fresh = {n: newer_images(feeds[n], n, start["applied"]) for n in given}
    taken = [taken_images(fresh[n], n) for n in sorted(given)]
    for name in given & {"modern_account", "modern_deposit", "verification", "attempt", "transaction"}:
        t[name] = apply_images(start[name], fresh[name], ROW_IDS[name])

    for name, why in failures().items():
        if name in given:
            bad.append(failed_rejects(feeds[name], name, why, now))
            feeds[name] = feeds[name].filter(why.isNull())

    # Stage 1: modern side. Accounts leave users and bank accounts that deposits look up;
    # deposits leave verifications that accounts look up.
    made: Tables = {}
    parties = None
    if "modern_account" in given:
        parties = modern.resolve_parties(feeds["modern_account"], start, keep)
        parties = tuple(keep(p) for p in parties)
        t["user"] = start["user"].unionByName(parties[1])
        t["bank_account"] = start["bank_account"].unionByName(parties[2])

    deposits = _empty(spark, DEPOSIT_RESULT)
    # Both modern flows look verifications up as they are before each event.
    before = {}
    if "verification" in given:
        before = {
            FIRST + "verification": start["verification"],
            VERSIONS + "verification": keep(row_versions("verification", start, fresh)),
        }
    if "modern_deposit" in given:
        enriched = keep(modern.enrich_deposits(feeds["modern_deposit"], t | before, keep))
        deposits = modern.apply_modern_deposits(
            feeds["modern_deposit"], t, now, mask=mask, enriched=enriched
        )
        made["attempt"] = deposits["attempt_events"]
        transactions = [start["applied"], *taken]
        transactions = union_all(transactions).filter("feed = 'transaction'")
        t.update(modern.deposit_tables(t, deposits, transactions.select("row_id", "seq")))
        # What a posting sets is newer than any image before it.
        posted = t["transaction"].join(deposits["posting"], ["bank_account_verification_id"])
        taken.append(posted.select(F.lit("transaction").alias("feed"), F.col("id").alias("row_id"), "seq"))

    account_feed = fresh.get("customer_account", feeds["customer_account"])
    accounts = _empty(spark, ACCOUNT_RESULT)
    customer_accounts = apply_images(
        start["customer_account"], account_feed, ROW_IDS["customer_account"]
    )
    t["customer_account"] = customer_accounts
    if parties is not None:
        if given & {"verification", "modern_deposit"}:
            made_before = row_versions("verification", start, fresh, [deposits["verification"]])
            before = {
                FIRST + "verification": start["verification"],
                VERSIONS + "verification": keep(made_before),
            }
        decided = keep(
            modern.decide_accounts(
                parties[0], t | before | {"customer_account": start["customer_account"]},
                account_feed=account_feed if "customer_account" in given else None,
                fix_exists=fix_exists, cut=keep,
            )
        )
        accounts = modern.apply_modern_accounts(
            parties[0], t, now, parties=parties, mask=mask, decided=decided
        )
        verified = accounts["verification_patch"]
        key = "bank_account_verification_id"
        seen = union_all([start["applied"], *taken]).filter("feed = 'verification'")
        seen = seen.groupBy(F.col("row_id").alias(key)).agg(F.max("seq").alias("_taken"))
        newest = verified.join(seen, [key], "left").filter("_taken IS NULL OR seq > _taken")
        t["verification"] = update_from(
            t["verification"], newest, [key], ["verified_date", "result"]
        ).unionByName(accounts["verification"])
        taken.append(verified.select(F.lit("verification").alias("feed"), F.col(key).alias("row_id"), "seq"))
        final = keep(modern.account_snapshot(start["customer_account"], accounts, account_feed))
        made["customer_account"] = modern.derived_account_events(customer_accounts, final, accounts)
        t["customer_account"] = final.drop("born_seq")
    seen = dict(t)
    # What the second stage looks up in a table that changes in this batch, it reads from the
    # rows' versions, those that modern verifications leave among them.
    if given & {"verification", "modern_account", "modern_deposit"}:
        new = [part["verification"] for part in (accounts, deposits)]
        versions = keep(
            row_versions("verification", start, fresh, new, accounts["verification_patch"])
        )
        if parties is not None:
            versions, made["verification"] = modern.verified_versions(
                versions, accounts["verification_patch"]
            )
            versions = keep(versions)
        seen[VERSIONS + "verification"] = versions
    for name in given & {"modern_account", "modern_deposit"}:
        seen[VERSIONS + name] = keep(row_versions(name, start, fresh))
    for name in ("verification", "modern_account", "modern_deposit"):
        seen[FIRST + name] = start[name]
    t["id_map"] = update_from(
        start["id_map"].unionByName(accounts["id_map"]), deposits["id_map_patch"],
        ["modern_bank_account_id"], ["modern_micro_deposit_id", "legacy_micro_deposit_id"],
    )

    # Stage 2: legacy side. It reads what changes in the batch as it is before each event.
    if given & {"transaction", "modern_deposit"}:
        seen[FIRST + "transaction"] = start["transaction"]
        seen[legacy.TXN_VERSIONS] = keep(transaction_versions(fresh.get("transaction"), deposits, t))
    changes = [fresh["customer_account"]] if "customer_account" in given else []
    changes += [made["customer_account"]] if "customer_account" in made else []
    if changes:
        seen[FIRST + "customer_account"] = start["customer_account"]
        seen[legacy.ACCOUNT_EVENTS] = union_all(changes)

    def legacy_feed(name: str) -> DataFrame | None:
        parts = [feeds[name]] if name in given else []
        if name in made:
            parts.append(made[name])
        return union_all(parts) if parts else None

    results = []
    if (ev := legacy_feed("customer_account")) is not None:
        enriched = keep(legacy.enrich_customer_accounts(ev, seen, keep))
        results.append(legacy.apply_customer_accounts(ev, t, now, mask=mask, enriched=enriched))
    if (ev := legacy_feed("verification")) is not None:
        tries = legacy_feed("attempt")
        enriched = keep(legacy.enrich_verifications(ev, seen, keep, start["attempt"], tries))
        results.append(legacy.apply_verifications(ev, t, now, mask=mask, enriched=enriched))
    if (ev := legacy_feed("attempt")) is not None:
        enriched = keep(legacy.enrich_attempts(ev, seen, start["attempt"], keep))
        results.append(legacy.apply_attempts(ev, t, now, enriched=enriched))
    # Postings of the deposit flow touch migrated verifications only, which this flow leaves.
    if (ev := legacy_feed("transaction")) is not None:
        results.append(legacy.apply_transaction_status(ev, seen, now))
    patches = empty_patches(spark)
    if results:
        patches = keep(union_all([r["patches"] for r in results]))
    t["target"] = apply_patches(start["target"], patches, SHAPE, strict_keys=strict_keys)

    changed = keep(union_all([_none_applied(spark), *taken]).filter("row_id IS NOT NULL"))
    # One aggregate over the rows of this batch and what was noted of them before.
    row = ["feed", "row_id"]
    rows = changed.select(*row).distinct()
    again = start["applied"].join(rows, row, "left_semi")
    newest = again.unionByName(changed).groupBy(*row).agg(F.max("seq").alias("seq"))
    t["applied"] = start["applied"].join(rows, row, "left_anti").unionByName(newest)

    logs = [accounts["log"], deposits["log"], *[r["log"] for r in results], *bad]
    if strict_keys:
        logs.append(legacy.keyless_rejects(patches, now))
    outputs = {
        "case": accounts["case"].unionByName(deposits["case"]),
        "audit": accounts["audit"].unionByName(deposits["audit"]),
        "history": accounts["history"],
        "outbox": accounts["outbox"],
        "log": union_all(logs),
    }
    events = None if parties is None else parties[0]
    touched = _touched(feeds, given, accounts, deposits, events, patches)
    touched["applied"] = changed.select("row_id").distinct()
    return BatchResult(outputs, t, touched, patches, keep.release)


def row_versions(
    name: str, start: Tables, fresh: Tables, new: Sequence[DataFrame] = (), patch: DataFrame | None = None
) -> DataFrame:
    """All versions of the rows of table ``name`` that this batch changes: columns, seq, there.

    ``fresh`` has the feeds' events, ``new`` rows made in the batch, ``patch`` names rows that change otherwise.
    """
    key, cols = ROW_IDS[name], [f.name for f in schema(TABLES[name]).fields]
    parts = []
    if name in fresh:
        there = F.col("op") != "D"
        image = {c: F.when(there, F.col(f"after.{c}")) for c in cols} | {key: _row_id(name)}
        parts.append(
            fresh[name].select(*[image[c].alias(c) for c in cols], "seq", there.alias("there"))
        )
    for rows in new:
        parts.append(rows.select(*cols, born(key).cast("long").alias("seq"), F.lit(True).alias("there")))
    ids = [p.select(key) for p in parts] + ([patch.select(key)] if patch is not None else [])
    stored = start[name].join(union_all(ids).distinct(), [key], "left_semi")
    return union_all(
        [stored.select(*cols, F.lit(-1).cast("long").alias("seq"), F.lit(True).alias("there")), *parts]
    )


def transaction_versions(feed: DataFrame | None, deposits: Tables, after: Tables) -> DataFrame:
    """Transactions as this batch's events leave them: (verification, id, seq, values, is_new).

    Images of the feed, rows that deposits make, and postings, which set all transactions of a
    verification to Processed.
    """
    key = "bank_account_verification_id"
    cols = [key, "id", "created_date", "amount", "status"]
    parts = []
    if feed is not None:
        images = feed.filter("op <> 'D'")
        parts.append(
            images.select(
                *[F.col(f"after.{c}").alias(c) for c in cols], "seq", (F.col("op") == "I").alias("is_new")
            )
        )
    made = deposits["transaction"]
    parts.append(made.select(*cols, born("id").cast("long").alias("seq"), F.lit(True).alias("is_new")))
    rows = after["transaction"].select(*[c for c in cols if c != "status"])
    posted = rows.join(deposits["posting"].select(key, "seq"), key)
    parts.append(
        posted.filter(born("id") < F.col("seq")).select(
            key, "id", "created_date", "amount", F.lit("Processed").alias("status"), "seq",
            F.lit(False).alias("is_new"),
        )
    )
    return union_all(parts)


def _none_applied(spark: SparkSession) -> DataFrame:
    return empty(spark, schema(APPLIED))


def _empty(spark: SparkSession, ddls: dict[str, str]) -> Tables:
    return {n: empty(spark, schema(ddl)) for n, ddl in ddls.items()}


def empty_patches(spark: SparkSession) -> DataFrame:
    ddl = ", ".join(f"{c} {k}" for c, k in zip(SHAPE.columns, SHAPE.types, strict=True))
    return empty(
        spark,
        T.StructType.fromDDL(
            f"legacy_customer_id long, routing_number string, account_number string, seq long, "
            f"event_id string, {ddl}, update_mask long, insert_mask long"
        ),
    )


def _touched(feeds, given, accounts, deposits, events, patches) -> dict[str, DataFrame]:
    """Changed key values of every table that can have changed."""
    ver = "bank_account_verification_id"

    def fed(name: str, col: str) -> list[DataFrame]:
        if name not in given:
            return []
        images = ("before", "after")
        return [
            feeds[name].filter(F.col(i).isNotNull()).select(F.col(f"{i}.{col}").alias(col))
            for i in images
        ]

    parts: dict[str, list[DataFrame]] = {
        "modern_account": fed("modern_account", "stage_sequence_id"),
        "modern_deposit": fed("modern_deposit", "stage_sequence_id"),
        "customer_account": fed("customer_account", "customer_id"),
        "verification": fed("verification", ver),
        "attempt": fed("attempt", "id"),
        "transaction": fed("transaction", ver),
        "target": [patches],
    }
    if events is not None:
        # Every account the modern side opens, moves or removes belongs to a customer it names.
        parts["customer_account"].append(
            events.select(F.col("after.legacy_customer_id").alias("customer_id"))
        )
        parts["verification"] += [accounts["verification"], accounts["verification_patch"]]
        parts["bank_account"] = [accounts["bank_account"]]
        parts["user"] = [accounts["user"]]
        parts["id_map"] = [accounts["id_map"]]
    if "modern_deposit" in given:
        parts["verification"].append(deposits["verification"])
        parts["attempt"].append(deposits["attempt"])
        parts["transaction"] += [deposits["transaction"], deposits["posting"]]
        parts["lock"] = [deposits["lock"]]
        parts["deposit_verification"] = [
            deposits[n] for n in ("deposit_verification", "posting", "cancelling")
        ]
        parts["id_map"] = [*parts.get("id_map", []), deposits["id_map_patch"]]
    return {n: _keys(frames, *REPLACE_KEYS[n]) for n, frames in parts.items() if frames}
