"""Flows from the modern side: external accounts and micro-deposits change legacy tables.

Both flows return a dict of DataFrames: rows to append (``case``, ``audit``, ``history``,
``outbox``, ``log``), new rows and patches of the legacy tables, and the derived changes
that the legacy-side flows see with origin MODERN.

Generated numbers come from the event's ``seq`` (see ``generate.numeric_id``), and an event's
reference number is its ``event_id``, so a replay generates the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.functions import codes
from duosync.functions.columns import (
    plus_micros,
    recode_account_type,
    recode_channel,
    recode_verification,
    text,
)
from duosync.operators.generate import (
    assign_ids,
    audit_lines,
    expand_md,
    history_rows,
    numeric_id,
    open_cases,
    outbox,
    verification_rows,
)
from duosync.operators.lookup import (
    during,
    enrich,
    enrich_as_of,
    find_or_create,
    first_match,
    inner,
    latest,
    pick_one,
    restrict,
    same_day,
    update_from,
)
from duosync.operators.merge import compare_and_set, one_primary
from duosync.operators.ordered import running
from duosync.operators.rejects import (
    MODERN_TO_LEGACY,
    prefixed_id,
    rejects,
    trace,
    union_all,
)
from duosync.operators.route import MODERN, has_changed, is_true, touching, went
from duosync.operators.scan import WIDTH, let, states_before
from duosync.plans.lineage import let_go, no_cut
from duosync.plans.versions import VERSIONS, ranges_of
from duosync.sources.feeds import as_events, diff_snapshots
from duosync.sources.schemas import VERIFICATION, schema

Tables = dict[str, DataFrame]
Cut = Callable[[DataFrame], DataFrame]
ACCOUNT_KEY = ["customer_id", "routing_number", "account_number"]
AMBIGUOUS_ACCOUNT = "AMBIGUOUS_CUSTOMER_ACCOUNT"
NO_VERIFICATION = "NO_MATCHING_VERIFICATION"
AMBIGUOUS_VERIFICATION = "AMBIGUOUS_VERIFICATION"

CHECKING, SAVINGS = codes.ACCOUNT_TYPE_CODINGS["id"]
A, B = "after", "before"


def _new(c: str) -> Column:
    return F.col(f"{A}.{c}")


def _old(c: str) -> Column:
    return F.col(f"{B}.{c}")


# ------------------------------------------------------------------- users, bank accounts, cards


def resolve_parties(
    ev: DataFrame, tables: Tables, cut: Cut = no_cut
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Add ``user_id`` and ``bank_id`` to account events → (events, new users, new banks).

    Runs before any gate: also an event that does nothing else leaves its user and bank.
    """
    out = ev.withColumns(
        {
            "individual_identifier": _new("legacy_customer_id"),
            "aba_number": _new("routing_number"),
            "account_number": _new("account_number"),
            "bank_type": recode_account_type(_new("account_type"), "short", "long", "savings"),
        }
    )
    read = cut(out)
    users = (
        tables["user"]
        .filter(F.col("identifier_type") == codes.USER_IDENTIFIER_TYPE)
        .select("individual_identifier", F.col("id").alias("user_id"))
    )

    def make_users(makers: DataFrame) -> DataFrame:
        named = makers.select(
            "individual_identifier",
            "seq",
            F.col("individual_identifier").alias("customer_id"),
            _new("credit_account_id").alias("credit_account_id"),
        )
        holders = tables["holder"].join(tables["name"], ["name_id"]).select(
            "customer_id", "credit_account_id", F.col("name").alias("individual_name")
        )
        named = first_match(
            named, holders, ["customer_id", "credit_account_id"], [F.col("individual_name")]
        )
        return named.select(
            numeric_id("seq", "user").alias("user_id"),
            "individual_identifier",
            F.lit(codes.USER_IDENTIFIER_TYPE).cast("int").alias("identifier_type"),
            "individual_name",
            F.lit(None).cast("long").alias("id_old"),
        )

    out, new_users = find_or_create(
        read, users, ["individual_identifier"], "seq", make_users, "user_id",
        needs=[F.struct(_new("credit_account_id").alias("credit_account_id")).alias(A)],
    )
    # A user made for a NULL customer belongs to its own event only.
    out = cut(
        out.withColumn(
            "user_id",
            F.when(F.col("individual_identifier").isNull(), numeric_id("seq", "user")).otherwise(
                F.col("user_id")
            ),
        )
    )
    new_users = cut(new_users)
    let_go(cut, read)

    bank_keys = ["aba_number", "account_number", "bank_type"]
    banks = tables["bank_account"].select(
        "aba_number",
        "account_number",
        F.col("account_type").alias("bank_type"),
        F.col("id").alias("bank_id"),
    )

    def make_banks(makers: DataFrame) -> DataFrame:
        return makers.select(numeric_id("seq", "bank").alias("bank_id"), *bank_keys)

    out, new_banks = find_or_create(out, banks, bank_keys, "seq", make_banks, "bank_id", needs=[])
    new_users = new_users.withColumnRenamed("user_id", "id")
    new_banks = new_banks.select(
        F.col("bank_id").alias("id"),
        "aba_number",
        "account_number",
        F.col("bank_type").alias("account_type"),
    )
    return out.drop("individual_identifier", "aba_number", "account_number", "bank_type"), new_users, new_banks


def with_card(
    df: DataFrame,
    tables: Tables,
    credit: str = "credit_account_id",
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Add ``card_id``, the current card of the credit account."""
    cards = (
        tables["card"]
        .filter(F.col("current_card") == 1)
        .select(F.col("credit_account_id").alias(credit), "card_id")
    )
    return first_match(df, cards, [credit], [F.col("card_id")], wanted)


# --------------------------------------------------- which customer account an event finds

_ROW = "struct<alive: boolean, id: bigint, is_primary: int>"


def account_entries(accounts: DataFrame, feed: DataFrame | None) -> DataFrame:
    """History of customer accounts as (key, type, seq, row, several).

    Stored accounts enter at seq -1, legacy changes at their own. ``several`` marks two
    stored rows for one key and type.
    """
    stored = accounts.groupBy(*ACCOUNT_KEY, "account_type_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("customer_bank_account_id", "is_primary")).alias("first"),
    )
    entries = stored.select(
        *ACCOUNT_KEY,
        "account_type_id",
        F.lit(-1).cast("long").alias("seq"),
        _row(F.lit(True), F.col("first.customer_bank_account_id"), F.col("first.is_primary")),
        (F.col("n") > 1).alias("several"),
    )
    if feed is None:
        return entries
    # An update leaves its old key and type and enters the new ones.
    leaves = feed.filter(
        (F.col("op") == "D")
        | ((F.col("op") == "U") & ~_same_place())
    ).select(
        *[_old(k).alias(k) for k in ACCOUNT_KEY],
        _old("account_type_id").alias("account_type_id"),
        "seq",
        _row(F.lit(False), F.lit(None), F.lit(None)),
        F.lit(False).alias("several"),
    )
    enters = feed.filter(F.col("op") != "D").select(
        *[_new(k).alias(k) for k in ACCOUNT_KEY],
        _new("account_type_id").alias("account_type_id"),
        "seq",
        _row(F.lit(True), _new("customer_bank_account_id"), _new("is_primary")),
        F.lit(False).alias("several"),
    )
    return entries.unionByName(leaves).unionByName(enters)


def _same_place() -> Column:
    same = F.lit(True)
    for c in [*ACCOUNT_KEY, "account_type_id"]:
        same = same & _old(c).eqNullSafe(_new(c))
    return same


def _row(alive: Column, account_id: Column, primary: Column) -> Column:
    return F.struct(
        alive.cast("boolean").alias("alive"),
        account_id.cast("long").alias("id"),
        primary.cast("int").alias("is_primary"),
    ).alias("row")


def _gates() -> dict[str, Column]:
    """Conditions of an account event that need no lookup."""
    usable = is_true(_new("single_use") != "1")
    kind = _new("operation_type")
    update = (F.col("op") == "U") & usable
    editing = update & is_true(kind.isin("UPDATE", "PRIMARY_UPDATE"))
    return {
        "is_add": (F.col("op") == "I") & usable & is_true(kind == "ADD"),
        "is_move": update
        & is_true(
            (kind == "UPDATE")
            & went("result", "PENDING_ACH_VERIFICATION", "PENDING_ACH_VALIDATION")
        ),
        "is_verify": update
        & is_true((kind == "UPDATE") & went("result", "PENDING_ACH_VALIDATION", "ACTIVE")),
        "is_promotion": editing & is_true(went("is_primary", 0, 1)),
        "is_reroute": update
        & is_true((kind == "UPDATE") & has_changed(["routing_number", "account_number"])),
        "is_retype": editing
        & is_true(
            (_old("routing_number") == _new("routing_number"))
            & (_old("account_number") == _new("account_number"))
            & has_changed(["account_type"])
        ),
        "is_delete": update & is_true(kind == "DELETE"),
        "changes_type": is_true(has_changed(["account_type"])) & (F.col("op") == "U"),
        "is_active": is_true(_new("result") == "ACTIVE"),
        "old_checking": is_true(_old("account_type") == "CHK"),
        "old_savings": is_true(_old("account_type") == "SAV"),
        "new_type": recode_account_type(_new("account_type"), "short", "id", None),
    }


def find_accounts(
    ev: DataFrame, entries: DataFrame, *, fix_exists: bool = False, width: int | None = None
) -> DataFrame:
    """Lay events and account history on one line per account and read off, for each event,
    the checking and savings rows as they stand just before it.

    Creations of the batch count too. Whether a savings row exists follows from the line
    alone; a checking row is added only where no savings row exists, so it is resolved second.
    """
    account = numeric_id("seq", "account")
    line = ev.select(
        *ACCOUNT_KEY, "seq", F.struct(*[c for c in ev.columns if c not in (*ACCOUNT_KEY, "seq")]).alias("_ev")
    )
    line = line.withColumns(
        {
            "account_type_id": F.lit(None).cast("int"),
            "row": F.lit(None).cast(_ROW),
            "several": F.lit(False),
        }
    ).unionByName(entries, allowMissingColumns=True)
    is_event = F.col("_ev").isNotNull()

    def e(name: str) -> Column:
        return F.coalesce(F.col(f"_ev.{name}"), F.lit(False))

    opens = (e("is_add") & e("is_active")) | (e("is_move") & ~e("old_checking"))
    save = opens & (F.col("_ev.new_type") == SAVINGS)
    add_check = e("is_add") & e("is_active") & (F.col("_ev.new_type") == CHECKING)
    set_check = e("is_move") & e("old_checking") & (F.col("_ev.new_type") == CHECKING)
    drop_save = e("is_delete") & ~e("old_checking")
    drop_check = e("is_delete") & e("old_checking")
    save, add_check, set_check = is_true(save), is_true(add_check), is_true(set_check)

    def entry(type_id: int) -> Column:
        return ~is_event & (F.col("account_type_id") == type_id)

    opened = F.struct(
        F.lit(True).alias("alive"), account.alias("id"), F.lit(0).cast("int").alias("is_primary")
    )
    closed = F.struct(
        F.lit(False).alias("alive"),
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("int").alias("is_primary"),
    )
    line = running(
        line, ACCOUNT_KEY, "seq",
        {
            "_save": (
                "last",
                F.when(entry(SAVINGS), F.col("row.alive")).when(save, True).when(drop_save, False),
            ),
            # Only for fix_exists, which looks for the event's own type on inserts as well.
            "_check": (
                "last",
                F.when(entry(CHECKING), F.col("row.alive"))
                .when(add_check | set_check, True)
                .when(drop_check, False),
            ),
        },
        width=width,
    )
    has_save = F.coalesce(F.col("_save"), F.lit(False))
    has_check = F.coalesce(F.col("_check"), F.lit(False))
    blocked = has_check if fix_exists else has_save
    line = line.withColumns({"_opens_save": save & ~has_save, "_adds_check": add_check & ~blocked})
    line = running(
        line, ACCOUNT_KEY, "seq",
        {
            "save_row": (
                "last",
                F.when(entry(SAVINGS), F.col("row"))
                .when(F.col("_opens_save"), opened)
                .when(drop_save, closed),
            ),
            "save_several": ("max", F.when(entry(SAVINGS), F.col("several"))),
            "_check2": (
                "last",
                F.when(entry(CHECKING), F.col("row.alive"))
                .when(F.col("_adds_check") | set_check, True)
                .when(drop_check, False),
            ),
        },
        width=width,
    )
    check_alive = F.coalesce(F.col("_check2"), F.lit(False))
    line = line.withColumns(
        {
            "_opens_check": F.col("_adds_check") | (set_check & ~check_alive),
            "_doubles": F.col("_adds_check") & check_alive,
        }
    )
    line = running(
        line, ACCOUNT_KEY, "seq",
        {
            "check_row": (
                "last",
                F.when(entry(CHECKING), F.col("row"))
                .when(F.col("_opens_check"), opened)
                .when(drop_check, closed),
            ),
            "check_several": (
                "max",
                F.when(entry(CHECKING), F.col("several")).when(F.col("_doubles"), True),
            ),
        },
        width=width,
    )
    fields = [c for c in ev.columns if c not in (*ACCOUNT_KEY, "seq")]
    return line.filter(is_event).select(
        *ACCOUNT_KEY,
        "seq",
        *[F.col(f"_ev.{c}").alias(c) for c in fields],
        "save_row",
        "check_row",
        _count("save").alias("n_save"),
        _count("check").alias("n_check"),
    )


# What ``find_accounts`` reads of an event.
FOUND_BY = ["is_add", "is_active", "is_move", "is_delete", "old_checking", "new_type"]


def with_rows(ev: DataFrame, found: DataFrame) -> DataFrame:
    """Events with the rows ``find_accounts`` found for them, by ``_place``, their number as written."""
    rows = found.select(F.col("_place").alias("_found_place"), "save_row", "check_row", "n_save", "n_check")
    return ev.join(rows, ev["_place"] == rows["_found_place"]).drop("_place", "_found_place")


def _count(which: str) -> Column:
    return (
        F.when(F.coalesce(F.col(f"{which}_several"), F.lit(False)), 2)
        .when(F.coalesce(F.col(f"{which}_row.alive"), F.lit(False)), 1)
        .otherwise(0)
    )


Get = Callable[[str], Column]


def _lookups(c: Get, fix_exists: bool) -> dict[str, Column]:
    """What an event reads off the two rows it finds; ``c`` gives a column of the event or the rows."""
    old_checking, new_type = c("old_checking"), c("new_type")
    # An insert has no old image, so its lookup goes for savings.
    looks_checking = (
        F.when(c("op") == "I", is_true(new_type == CHECKING)).otherwise(old_checking)
        if fix_exists
        else old_checking
    )

    def by_type(cond: Column, what: str) -> Column:
        check, save = (
            (c("check_row")[what], c("save_row")[what]) if what != "n" else (c("n_check"), c("n_save"))
        )
        return F.when(cond, check).otherwise(save)

    return {
        "exists": by_type(looks_checking, "n") > 0,
        "found_id": by_type(looks_checking, "id"),
        "found_primary": by_type(looks_checking, "is_primary"),
        # Strict lookups: by the new type, by the old type, by the old type with
        # everything but checking taken as savings.
        "n_new": F.when(new_type.isNull(), 0).otherwise(by_type(new_type == CHECKING, "n")),
        "new_id": F.when(new_type.isNotNull(), by_type(new_type == CHECKING, "id")),
        "n_old": F.when(old_checking, c("n_check"))
        .when(c("old_savings"), c("n_save"))
        .otherwise(0),
        "old_id": by_type(old_checking, "id"),
        "n_gone": by_type(old_checking, "n"),
    }


def _outcomes(c: Get) -> dict[str, Column]:
    """What an event does, from its gates and ``_lookups``."""
    old_checking, new_type = c("old_checking"), c("new_type")
    registers = c("is_add") & ~c("exists")
    promotes = c("is_promotion") & c("exists") & is_true(c("found_primary") != 1)
    stopped = promotes & (c("n_new") == 0)
    other_type = is_true(F.when(old_checking, CHECKING).otherwise(SAVINGS) != new_type)
    retypes = c("is_retype") & c("exists") & other_type & ~stopped
    return {
        "registers": registers,
        "opens": (registers & c("is_active")) | (c("is_move") & ~c("exists")),
        "ambiguous": (promotes & (c("n_new") > 1))
        | (retypes & (c("n_old") > 1))
        | (c("is_delete") & (c("n_gone") > 1)),
        "promotes": promotes & (c("n_new") == 1),
        "logs_route": c("is_reroute") & ~stopped,
        "retypes": retypes & (c("n_old") == 1),
        "removes": c("is_delete") & (c("n_gone") == 1),
        "misses": c("is_delete") & (c("n_gone") == 0),
    }


def decide(df: DataFrame, *, fix_exists: bool = False) -> DataFrame:
    """Turn the rows an event finds into what it does."""
    df = df.withColumns(_lookups(F.col, fix_exists)).withColumns(_outcomes(F.col))
    vtype, res = _new("verification_type"), _new("result")
    steps_up = F.col("registers") & is_true(
        (vtype.isNull() & (res == "PENDING_ACH_VERIFICATION"))
        | ((vtype == "AGENT") & (res == "ACTIVE"))
    )
    return df.withColumn("steps_up", steps_up)


# The two rows of an account as a state. ``src`` says that a row is still the savings (1) or the
# checking row (2) a chunk of events began with, whose id is not known inside the chunk.
_SLOT = "struct<alive: boolean, id: bigint, is_primary: int, src: int>"
_STATE = f"struct<save: {_SLOT}, save_several: boolean, check: {_SLOT}, check_several: boolean>"
# What a lookup can tell of a row: none; one or several, each with the flag NULL, not 1, or 1.
_FLAGS = (None, 0, 1)
_CLASSES = 1 + 2 * len(_FLAGS)


def _slot(alive: bool | Column, account_id: Column | None, primary: Column | int | None, src: int = 0) -> Column:
    values = (alive, account_id, primary, src)
    return F.struct(*[v if isinstance(v, Column) else F.lit(v) for v in values]).cast(_SLOT)


def _state(save: Column, save_several: Column, check: Column, check_several: Column) -> Column:
    return F.struct(save, save_several, check, check_several).cast(_STATE)


def _class(state: Column, which: str) -> Column:
    primary = state[which]["is_primary"]
    flag = F.when(primary.isNull(), 1).when(primary == 1, 3).otherwise(2)
    several = state[f"{which}_several"]
    return F.when(several, flag + len(_FLAGS)).when(state[which]["alive"], flag).otherwise(0)


def _beginnings() -> list[Column]:
    """A state for each pair of classes, in the order of ``_carry``."""

    def row(k: int, src: int) -> Column:
        return _slot(True, None, _FLAGS[(k - 1) % len(_FLAGS)], src) if k else _slot(False, None, None)

    both = [(a, b) for a in range(_CLASSES) for b in range(_CLASSES)]
    several = len(_FLAGS)
    return [_state(row(a, 1), F.lit(a > several), row(b, 2), F.lit(b > several)) for a, b in both]


def _carry(state: Column, ends: Column) -> Column:
    """The state after a chunk: the end for the state's class, with the state's own rows put in."""

    def place(end: Column, which: str) -> Column:
        src = end[which]["src"]
        return F.when(src == 1, state["save"]).when(src == 2, state["check"]).otherwise(end[which])

    end = F.get(ends, _class(state, "save") * _CLASSES + _class(state, "check"))
    return let(
        end,
        lambda e: _state(place(e, "save"), e["save_several"], place(e, "check"), e["check_several"]),
    )


def _found_row(state: Column, which: str) -> dict[str, Column]:
    n = F.when(state[f"{which}_several"], 2).when(state[which]["alive"], 1).otherwise(0)
    return {f"{which}_row": state[which], f"n_{which}": n}


def _move_on(fix_exists: bool) -> Callable[[Column, Column], Column]:
    """The step of an account's state: an event does what ``decide`` says, an entry is what it is."""
    gone = _slot(False, None, None)

    def by_event(state: Column, item: Column) -> Column:
        rows = {**_found_row(state, "save"), **_found_row(state, "check")}
        seen = _lookups(lambda n: rows[n] if n in rows else item[n], fix_exists)
        known = {**rows, **seen}
        does = _outcomes(lambda n: known[n] if n in known else item[n])
        applied = ~does["ambiguous"] & ~item["unverified"]
        told = F.struct(
            *[(applied & does[n]).alias(n) for n in ("opens", "retypes", "removes")],
            *[F.coalesce(seen[n], F.lit(0)).alias(n) for n in ("n_new",)],
        )
        return let(told, lambda t: moved(state, item, t))

    def moved(state: Column, item: Column, t: Column) -> Column:
        opened = _slot(True, item["account"], 0)
        old = F.when(item["old_checking"], state["check"]).otherwise(state["save"])

        def of(which: str, kind: int, was: Column) -> tuple[Column, Column]:
            enters = is_true(item["new_type"] == kind)
            row = (
                F.when(t["opens"] & enters, opened)
                .when(t["retypes"] & enters, old)
                .when((t["retypes"] | t["removes"]) & was, gone)
                .otherwise(state[which])
            )
            doubles = (t["opens"] | t["retypes"]) & enters & (t["n_new"] > 0)
            return row, state[f"{which}_several"] | doubles

        return _state(
            *of("save", SAVINGS, ~item["old_checking"]), *of("check", CHECKING, item["old_checking"])
        )

    def by_entry(state: Column, item: Column) -> Column:
        row = item["row"]
        as_slot = _slot(row["alive"], row["id"], row["is_primary"])

        def of(which: str, kind: int) -> tuple[Column, Column]:
            here = is_true(item["account_type_id"] == kind)
            several = state[f"{which}_several"] | (here & item["several"])
            return F.when(here, as_slot).otherwise(state[which]), several

        return _state(*of("save", SAVINGS), *of("check", CHECKING))

    return lambda state, item: F.when(item["is_event"], by_event(state, item)).otherwise(by_entry(state, item))


def find_in_order(
    ev: DataFrame,
    entries: DataFrame,
    *,
    fix_exists: bool = False,
    width: int | None = None,
    cut: Cut = no_cut,
) -> DataFrame:
    """As ``find_accounts``, for accounts whose events move rows between types.

    What such an event does depends on the row it finds, and what later ones find on what it
    does, so the two rows of an account are run through as a state (``scan.states_before``).
    """
    no = F.lit(False)
    gates = ["op", "is_add", "is_active", "is_move", "is_promotion", "is_retype", "is_reroute", "is_delete",
             "old_checking", "old_savings", "new_type", "unverified"]
    event = {c: F.col(c) if c in ("op", "new_type") else F.coalesce(c, no) for c in gates}
    event |= {
        "is_event": F.lit(True), "account": numeric_id("seq", "account"), "several": no,
        "account_type_id": F.lit(None).cast("int"), "row": F.lit(None).cast(_ROW),
    }
    marks = [c for c in gates if c not in ("op", "new_type")]
    entry = {c: no if c in marks else F.lit(None) for c in gates}
    entry |= {
        "is_event": no, "account": F.lit(None), "several": F.coalesce("several", no),
        "account_type_id": F.col("account_type_id"), "row": F.col("row"),
    }

    def laid(df: DataFrame, fields: dict[str, Column], event_id: Column) -> DataFrame:
        flat = df.select(*ACCOUNT_KEY, "seq", event_id.alias("event_id"), *[v.alias(k) for k, v in fields.items()])
        return flat.withColumn("account", F.col("account").cast("long"))

    line = laid(ev, event, F.col("event_id")).unionByName(laid(entries, entry, F.lit(None).cast("string")))
    line = line.select(*ACCOUNT_KEY, "seq", F.struct("event_id", *event).alias("_item"))
    none = _slot(False, None, None)
    met = states_before(
        line, ACCOUNT_KEY, "seq", "_item",
        step=_move_on(fix_exists), start=_state(none, F.lit(False), none, F.lit(False)),
        starts=_beginnings(), apply=_carry, width=width or WIDTH, cut=cut,
    )
    state = F.col("found")
    columns = {**_found_row(state, "save"), **_found_row(state, "check")}
    for which in ("save", "check"):
        columns[f"{which}_row"] = F.when(
            state[which]["alive"], _row(state[which]["alive"], state[which]["id"], state[which]["is_primary"])
        )
    met = met.filter("_item.is_event").select(
        F.col("_item.event_id").alias("event_id"), *[v.alias(k) for k, v in columns.items()]
    )
    return ev.join(met, ["event_id"])


def decide_in_order(
    ev: DataFrame,
    entries: DataFrame,
    *,
    fix_exists: bool = False,
    width: int | None = None,
    cut: Cut = no_cut,
) -> DataFrame:
    """Decide all events of a batch, each on the rows that the events before it leave.

    ``ev`` has the columns of ``_gates`` and ``unverified``. Accounts with events after a type
    change go through ``find_in_order``, all others through running values. Either way the number
    of passes is fixed, however many type changes an account has.
    """
    # A count along the accounts needs no more of an event than this.
    read = cut(ev.withColumn("_place", F.monotonically_increasing_id()))
    line = read.select("_place", *ACCOUNT_KEY, "seq", *FOUND_BY, "changes_type")
    counted = running(line, ACCOUNT_KEY, "seq", {"_changes": ("count", F.col("changes_type"))})
    line = cut(counted.drop("changes_type"))
    moving = cut(line.filter("_changes > 0").select(*ACCOUNT_KEY).distinct())
    line, ev = line.drop("_changes"), read.drop("changes_type")

    def met(ev: DataFrame, line: DataFrame, entries: DataFrame) -> DataFrame:
        if cut is no_cut:  # A number that isn't written may change from one reading to the next.
            return find_accounts(ev.drop("_place"), entries, fix_exists=fix_exists)
        return with_rows(ev, find_accounts(line, entries, fix_exists=fix_exists))

    if moving.isEmpty():
        return cut(decide(met(ev, line, entries), fix_exists=fix_exists))
    still = met(*[part.join(moving, ACCOUNT_KEY, "left_anti") for part in (ev, line, entries)])
    moved = find_in_order(
        ev.drop("_place").join(moving, ACCOUNT_KEY, "left_semi"),
        entries.join(moving, ACCOUNT_KEY, "left_semi"),
        fix_exists=fix_exists,
        width=width,
        cut=cut,
    )
    return cut(decide(still.unionByName(moved), fix_exists=fix_exists))


# ----------------------------------------------------------------------------- external accounts


def verified_deposits(df: DataFrame, tables: Tables) -> DataFrame:
    """The micro-deposit verification that an activated account completes, as it is before the event.

    ``ver_from`` is the number of the image it is read from, -1 for the stored one.
    """
    out = df.withColumns(
        {
            "routing_number": _new("routing_number"),
            "account_number": _new("account_number"),
            "bank_type": recode_account_type(_new("account_type"), "short", "long", None),
            "credit_account_id": _new("credit_account_id"),
            "day": same_day(_new("created_timestamp")),
        }
    )
    account = ["routing_number", "account_number", "bank_type"]
    keys = [*account, "credit_account_id", "day"]
    banks = tables["bank_account"].select(
        F.col("id").alias("bank_account_id"),
        F.col("aba_number").alias("routing_number"),
        "account_number",
        F.col("account_type").alias("bank_type"),
    )
    banks = restrict(banks, out, account)

    def started(table: DataFrame, *more: str) -> DataFrame:
        return inner(banks, _migrated_deposits(table), ["bank_account_id"]).select(
            *account,
            "credit_account_id",
            same_day("created_date").alias("day"),
            F.col("bank_account_verification_id").alias("ver_id"),
            F.col("work_case_id").alias("ver_case"),
            F.col("verified_date").alias("ver_date"),
            F.col("created_date").alias("ver_created"),
            *more,
        )

    order = ["ver_created", "ver_id"]
    cols = [*order, "ver_case", "ver_date"]
    if VERSIONS + "verification" not in tables:
        found = latest(out, started(tables["verification"]), keys, [F.col(c) for c in order])
        return found.withColumn("ver_from", F.lit(-1).cast("long"))
    ranges = ranges_of(tables, "verification", "bank_account_verification_id", started, keys, order)
    ranges = ranges.withColumn("ver_from", F.col("_from"))
    found = during(out, ranges, keys, "seq", [F.col(c) for c in order], [*cols, "ver_from"], "_found")
    return found.drop("_found")


def _migrated_deposits(verification: DataFrame) -> DataFrame:
    return verification.filter(
        (F.col("verification_type") == "MicroDeposit") & (F.col("is_migrated") == codes.MIGRATED)
    )


def apply_modern_accounts(
    ev: DataFrame,
    tables: Tables,
    now: Column,
    *,
    account_feed: DataFrame | None = None,
    parties: tuple[DataFrame, DataFrame, DataFrame] | None = None,
    mask: bool = True,
    fix_exists: bool = False,
    cut: Cut = no_cut,
    decided: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """External accounts: registration, verification, primary switch, type change, removal.

    ``account_feed`` holds the legacy side's customer-account events of the same batch.
    ``parties`` and ``decided`` take the steps' results where the caller has them already.
    """
    ev, new_users, new_banks = parties or resolve_parties(ev, tables, cut)
    if decided is None:
        decided = cut(
            decide_accounts(
                ev, tables, account_feed=account_feed, fix_exists=fix_exists, cut=cut
            )
        )

    fine = decided.filter(~F.col("ambiguous") & ~F.col("unverified"))
    created, updated = _new("created_timestamp"), _new("updated_timestamp")
    by, changed_by = _new("created_by"), _new("updated_by")
    channel = recode_channel(_new("channel"), "account")
    new_type = F.col("new_type")
    reg_case, reg_audit = numeric_id("seq", "registration"), numeric_id("seq", "registration_audit")
    step_case, step_audit = numeric_id("seq", "case"), numeric_id("seq", "case_audit")
    account_id = numeric_id("seq", "account")

    # Work cases and audits.
    step_ups = fine.filter("steps_up")
    registrations = fine.filter("opens OR retypes OR removes")
    at_start = F.col("op") == "I"
    cases = union_all(
        [
            open_cases(
                step_ups,
                uc_id=step_case,
                type_id=F.when(_new("result") == "ACTIVE", codes.CASE_EWS_ACTIVE).otherwise(
                    codes.CASE_EWS_PENDING
                ),
                open_date=created,
                open_agent=by,
                status_date=updated,
                status_agent=changed_by,
                credit_account_id=_new("credit_account_id"),
            ),
            open_cases(
                registrations,
                uc_id=reg_case,
                type_id=F.lit(codes.CASE_REGISTRATION),
                open_date=F.when(at_start, created).otherwise(updated),
                open_agent=F.when(at_start, by).otherwise(changed_by),
                status_date=updated,
                status_agent=changed_by,
                credit_account_id=_new("credit_account_id"),
            ),
        ]
    )
    verified = compare_and_set(
        fine.filter("is_verify"), ["ver_id", "ver_from"], "seq", F.col("ver_date"), updated
    )
    audits = union_all(
        [
            audit_lines(
                step_ups,
                F.when(_new("result") == "ACTIVE", "step_up_ok").otherwise("step_up_failed"),
                uc_id=step_case,
                uc_audit_id=step_audit,
                audit_date=updated,
                account=_new("account_number"),
                mask=mask,
            ),
            audit_lines(
                registrations,
                "registration",
                uc_id=reg_case,
                uc_audit_id=reg_audit,
                audit_date=updated,
                account=_new("account_number"),
                bank=F.col("bank_name"),
                routing=_new("routing_number"),
                account_type=_new("account_type"),
                mask=mask,
            ),
            audit_lines(
                verified,
                "verified",
                uc_id=F.col("ver_case"),
                uc_audit_id=numeric_id("seq", "audit"),
                audit_date=updated,
                account=_new("account_number"),
                mask=mask,
            ),
        ]
    )

    # Verification rows: one on step-up, then always the main one 11 µs later.
    main = recode_verification(
        _new("verification_type"), _new("result"), created, _new("verified_date")
    )

    def ver_struct(slot, kind, made, verified_at, case, result):
        return F.struct(
            numeric_id("seq", slot).alias("bank_account_verification_id"),
            kind.alias("verification_type"),
            made.alias("created_date"),
            verified_at.alias("verified_date"),
            case.cast("long").alias("work_case_id"),
            by.alias("agent"),
            channel.alias("channel"),
            result.alias("result"),
            _new("credit_account_id").alias("credit_account_id"),
            F.lit(codes.MIGRATED).cast("int").alias("is_migrated"),
            F.col("bank_id").alias("bank_account_id"),
            F.col("user_id").alias("user_id"),
        )

    first = ver_struct(
        "verification_initial", F.lit("Initial"), created, _new("verified_date"), F.lit(None),
        F.lit("StepUp"),
    )
    second = ver_struct(
        "verification", main["verification_type"], plus_micros(created), main["verified_date"],
        F.when(F.col("steps_up"), step_case), main["result"],
    )
    verifications = verification_rows(
        fine.filter("registers"), [], [F.when(F.col("steps_up"), first), second]
    )

    # Account history and outbox.
    def history(rows, code):
        return history_rows(
            rows, code,
            customer=_new("legacy_customer_id"),
            account=_new("account_number"),
            routing=_new("routing_number"),
            account_type_id=new_type,
            channel=channel,
        )

    promotions = fine.filter("promotes OR promotes_new").select(
        "event_id",
        F.col("customer_id"),
        F.col("promoted").alias("account_id"),
        "seq",
    )
    changed_rows = fine.filter("promotes").select("event_id", "after", "new_type").unionByName(
        fine.filter("retypes").select("event_id", "after", "new_type")
    )
    histories = union_all(
        [
            history(fine.filter("opens"), codes.HISTORY_INSERT),
            history(changed_rows, codes.HISTORY_UPDATE),
            history(fine.filter("removes"), codes.HISTORY_DELETE),
        ]
    )
    outboxes = outbox(
        promotions, codes.OUTBOX_PRIMARY, account_id="account_id"
    ).unionByName(
        outbox(fine.filter("retypes"), codes.OUTBOX_TYPE_CHANGE, account_id="old_id")
    )

    id_map = fine.filter("registers").select(
        _new("modern_bank_account_id").alias("modern_bank_account_id"),
        F.col("bank_id").alias("legacy_bank_account_id"),
        F.lit(codes.LOG_CREATED_BY).alias("created_by"),
        now.alias("created_timestamp"),
        F.lit(None).cast("long").alias("modern_micro_deposit_id"),
        F.lit(None).cast("long").alias("legacy_micro_deposit_id"),
    )

    # Log rows.
    stage_id = _new("stage_sequence_id")
    source = "modern_account"
    log = union_all(
        [
            trace(
                fine.filter("logs_route"), source, MODERN_TO_LEGACY, stage_id.cast("string"),
                codes.TRACE_ROUTE_CHANGE, now, status="INFO",
            ),
            trace(
                fine.filter("removes"), source, MODERN_TO_LEGACY, prefixed_id(source, stage_id),
                text(codes.TRACE_DELETE_PREFIX, F.col("old_id")), now,
                created_by=codes.TRACE_DELETE_CREATED_BY,
            ),
            rejects(
                fine.filter("misses"), source, MODERN_TO_LEGACY, prefixed_id(source, stage_id),
                codes.TRACE_DELETE_PREFIX, now,
            ),
            rejects(
                decided.filter("ambiguous OR unverified"), source, MODERN_TO_LEGACY,
                prefixed_id(source, stage_id),
                F.when(F.col("unverified"), NO_VERIFICATION).otherwise(AMBIGUOUS_ACCOUNT), now,
            ),
        ]
    )

    new_accounts = fine.filter("opens").select(
        account_id.alias("customer_bank_account_id"),
        "customer_id",
        "routing_number",
        "account_number",
        new_type.cast("int").alias("account_type_id"),
        F.lit(0).cast("int").alias("is_primary"),
        F.when(at_start, created).otherwise(updated).alias("created_date"),
        "seq",
    )
    return {
        "user": new_users,
        "bank_account": new_banks,
        "case": cases,
        "audit": audits,
        "verification": verifications,
        "verification_patch": verified.select(
            F.col("ver_id").alias("bank_account_verification_id"),
            updated.alias("verified_date"),
            F.lit("Pass").alias("result"),
            "seq",
            "event_id",
        ),
        "history": histories,
        "outbox": outboxes,
        "id_map": id_map,
        "log": log,
        "account_opened": new_accounts,
        "account_retyped": fine.filter("retypes").select(
            F.col("old_id").alias("customer_bank_account_id"), new_type.alias("account_type_id"), "seq"
        ),
        "account_removed": fine.filter("removes").select(
            F.col("old_id").alias("customer_bank_account_id"), "seq"
        ),
        "promotion": promotions,
    }


def decide_accounts(
    ev: DataFrame,
    tables: Tables,
    *,
    account_feed: DataFrame | None = None,
    fix_exists: bool = False,
    cut: Cut = no_cut,
) -> DataFrame:
    """Everything the outputs of the account flow are cut from; worth caching.

    ``ev`` comes from ``resolve_parties``.
    """
    ev = ev.withColumns(
        {
            "customer_id": _new("legacy_customer_id"),
            "routing_number": _new("routing_number"),
            "account_number": _new("account_number"),
        }
    )
    # Events that are rejected for want of a verification must leave no trace in what later
    # events find, so this is known before anything else.
    # The old image is read no further, so it goes.
    gated = cut(ev.withColumns(_gates()).drop(B))
    ev = gated
    hit = verified_deposits(ev.filter("is_verify").select("event_id", "seq", "after"), tables)
    hit = hit.select("event_id", "ver_id", "ver_case", "ver_date", "ver_from")
    ev = ev.join(hit, ["event_id"], "left")
    ev = ev.withColumn("unverified", F.col("is_verify") & F.col("ver_id").isNull())
    accounts = restrict(tables["customer_account"], ev, ACCOUNT_KEY)
    entries = account_entries(accounts, account_feed)
    entries = cut(restrict(entries, ev, ACCOUNT_KEY))
    decided = decide_in_order(ev, entries, fix_exists=fix_exists, cut=cut)
    let_go(cut, gated, entries)
    out = decided

    # The flag a promotion finds: what the customer's previous promotion of this batch left,
    # else what is stored.
    opens_primary = F.col("registers") & F.col("opens") & is_true(_new("is_primary") == 1)
    could = F.col("is_promotion") & F.col("exists") & (F.col("n_new") == 1)
    candidate = F.when(opens_primary, numeric_id("seq", "account")).when(
        could & F.col("found_primary").isNotNull(), F.col("new_id")
    )
    settles = ~F.col("ambiguous") & ~F.col("unverified")
    out = out.withColumn("promoted", F.when(settles, candidate))
    out = running(out, ["customer_id"], "seq", {"_primary": ("last", F.col("promoted"))})
    flag = F.when(
        F.col("_primary").isNotNull(), (F.col("_primary") == F.col("found_id")).cast("int")
    ).otherwise(F.col("found_primary"))
    out = out.withColumns(
        {
            "promotes": could & is_true(flag != 1) & F.col("promoted").isNotNull(),
            "promotes_new": opens_primary,
        }
    ).drop("_primary")

    settled = cut(out.withColumn("_credit", _new("credit_account_id")))
    let_go(cut, decided)
    out = with_card(settled, tables, "_credit", settled).drop("_credit")
    directory = tables["bank_directory"].select(
        F.col("rt_micr").alias("routing_number"), F.col("rt_instit").alias("bank_name")
    )
    return first_match(out, directory, ["routing_number"], [F.col("bank_name")], settled)


def account_snapshot(
    accounts: DataFrame, result: dict[str, DataFrame], feed: DataFrame | None = None
) -> DataFrame:
    """Customer accounts after the batch, with ``born_seq`` of each row's last full image.

    Per account the last full image, the last type change and the last removal are found by
    one aggregate over the changes; the primary flag is settled per customer.
    """
    row = [c for c in accounts.columns]
    key = "customer_bank_account_id"
    opened = result["account_opened"].select(
        key, "seq", F.lit("image").alias("kind"), F.struct(*row).alias("image"),
        F.lit(None).cast("int").alias("type_id"),
    )
    none = F.lit(None).cast(opened.schema["image"].dataType)

    def change(df, kind, type_id=None):
        return df.select(
            key, "seq", F.lit(kind).alias("kind"), none.alias("image"),
            (F.lit(None) if type_id is None else type_id).cast("int").alias("type_id"),
        )

    changes = [
        opened,
        change(result["account_retyped"], "type", F.col("account_type_id")),
        change(result["account_removed"], "gone"),
    ]
    if feed is not None:
        changes.append(
            feed.filter("op <> 'D'").select(
                _new(key).alias(key), "seq", F.lit("image").alias("kind"),
                F.struct(*[_new(c).alias(c) for c in row]).alias("image"),
                F.lit(None).cast("int").alias("type_id"),
            )
        )
        changes.append(change(feed.filter("op = 'D'").select(_old(key).alias(key), "seq"), "gone"))
    kind = F.col("kind")
    folded = union_all(changes).groupBy(key).agg(
        F.max_by(F.struct("image", "seq"), F.when(kind == "image", F.col("seq"))).alias("_image"),
        F.max_by(F.struct("type_id", "seq"), F.when(kind == "type", F.col("seq"))).alias("_type"),
        F.max(F.when(kind == "gone", F.col("seq"))).alias("_gone"),
    )
    stored = accounts.select(F.col(key), F.struct(*row).alias("_stored"))
    both = stored.join(folded, [key], "full_outer")
    born = F.coalesce(F.col("_image.seq"), F.lit(-1)).cast("long")
    image = F.coalesce(F.col("_image.image"), F.col("_stored"))
    both = both.select("*", born.alias("born_seq"), image.alias("_row"))
    alive = F.col("_row").isNotNull() & (
        F.col("_gone").isNull() | (F.col("born_seq") > F.col("_gone"))
    )
    retyped = F.col("_type.seq") > F.col("born_seq")
    out = both.filter(alive).select(
        *[
            (
                F.when(retyped, F.col("_type.type_id")).otherwise(F.col("_row.account_type_id"))
                if c == "account_type_id"
                else F.col(f"_row.{c}")
            ).alias(c)
            for c in row
        ],
        "born_seq",
    )
    return one_primary(
        out,
        result["promotion"].withColumnRenamed("account_id", key),
        account=key,
    )


def derived_account_events(
    before: DataFrame, after: DataFrame, result: dict[str, DataFrame]
) -> DataFrame:
    """Net changes the account flow made, as customer-account events of origin MODERN.

    ``before`` has the legacy side's own changes applied, so only modern ones differ. Each
    event takes the seq of the last modern change of its account or customer.
    """
    key = "customer_bank_account_id"
    per_account = union_all(
        [result[n].select(key, "seq") for n in ("account_opened", "account_retyped", "account_removed")]
    ).groupBy(key).agg(F.max("seq").alias("_account_seq"))
    per_customer = result["promotion"].groupBy("customer_id").agg(
        F.max("seq").alias("_customer_seq")
    )
    customers = union_all(
        [
            result["promotion"].select("customer_id"),
            result["account_opened"].select("customer_id"),
        ]
    ).distinct()
    # Only accounts of touched customers, and touched accounts, can differ.
    touched = per_account.select(key)

    def part(df):
        by_customer = df.join(customers, ["customer_id"], "left_semi")
        rest = df.join(touched, [key], "left_semi").join(customers, ["customer_id"], "left_anti")
        return by_customer.unionByName(rest)

    cols = [c for c in before.columns]
    ev = diff_snapshots(part(before), part(after.select(*cols)), [key])
    ev = ev.withColumns(
        {
            key: F.coalesce(_new(key), _old(key)),
            "customer_id": F.coalesce(_new("customer_id"), _old("customer_id")),
        }
    )
    ev = ev.join(per_account, [key], "left").join(per_customer, ["customer_id"], "left")
    seq = F.greatest("_account_seq", "_customer_seq")
    return as_events(
        ev,
        event_id=assign_ids(F.lit("account"), F.col(key), seq),
        seq=seq,
        op=F.col("op"),
        origin=F.lit(MODERN),
        before=F.col("before"),
        after=F.col("after"),
    )


# -------------------------------------------------------------------------------- micro-deposits


def enrich_deposits(ev: DataFrame, tables: Tables, cut: Cut = no_cut) -> DataFrame:
    """Micro-deposit events with bank, credit account, user, card and verification."""
    ev = touching(ev, ["verification_attempts", "locked", "md_status"])
    out = ev.select(
        "event_id",
        "seq",
        "op",
        "before",
        "after",
        _new("routing_number").alias("aba_number"),
        _new("account_number").alias("account_number"),
        recode_account_type(_new("account_type"), "short", "long", "savings").alias("account_type"),
        _new("modern_bank_account_id").alias("modern_bank_account_id"),
        _new("legacy_customer_id").alias("individual_identifier"),
    )
    read = cut(out)
    banks = tables["bank_account"].withColumnRenamed("id", "bank_id")
    bank_keys = ["aba_number", "account_number", "account_type"]
    out = first_match(read, banks, bank_keys, [F.col("bank_id")])
    staged = tables["modern_account"].select(
        "modern_bank_account_id", "credit_account_id", "stage_sequence_id"
    )
    out = first_match(
        out, staged, ["modern_bank_account_id"], [F.col("stage_sequence_id")], read
    )
    users = (
        tables["user"]
        .filter(F.col("identifier_type") == codes.USER_IDENTIFIER_TYPE)
        .select("individual_identifier", F.col("id").alias("user_id"))
    )
    out = first_match(out, users, ["individual_identifier"], [F.col("user_id")], read)
    starts = (F.col("op") == "I") & is_true(_new("md_status") == "InProgress")
    known = cut(out.withColumn("starts", starts))
    return _with_verification(with_card(known, tables), tables, known)


def _with_verification(out: DataFrame, tables: Tables, wanted: DataFrame) -> DataFrame:
    """Add ``n_ver``, ``ver_id`` and ``ver_case``: the verifications an update finds, stored
    ones and those started earlier in the batch."""
    keys = ["bank_id", "credit_account_id"]
    own_id, own_case = numeric_id("seq", "verification"), numeric_id("seq", "case")
    out = running(
        out, keys, "seq",
        {
            "_started": ("count", F.col("starts")),
            "_own": ("last", F.when(F.col("starts"), F.struct(own_id.alias("id"), own_case.alias("uc")))),
        },
    )

    def stored(table: DataFrame, *more: str) -> DataFrame:
        found = _migrated_deposits(table).select(
            F.col("bank_account_id").alias("bank_id"),
            "credit_account_id",
            F.struct(
                F.col("bank_account_verification_id").alias("id"), F.col("work_case_id").alias("uc")
            ).alias("_row"),
            *more,
        )
        return restrict(found, wanted, keys)

    if VERSIONS + "verification" in tables:
        ranges = ranges_of(tables, "verification", "bank_account_verification_id", stored, keys, ["_row"])
        out = during(out, ranges, keys, "seq", [F.col("_row")], ["_row"], "_stored")
    else:
        counted = stored(tables["verification"]).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_stored"), F.min("_row").alias("_row")
        )
        out = out.join(counted, keys, "left")
    n = F.coalesce(F.col("_stored"), F.lit(0)) + F.col("_started")
    one = F.coalesce(F.col("_row"), F.col("_own"))
    return out.withColumns(
        {
            "n_ver": n,
            "ver_id": F.when(n == 1, one["id"]),
            "ver_case": F.when(n == 1, one["uc"]),
        }
    ).drop("_started", "_own", "_stored", "_row")


def apply_modern_deposits(
    ev: DataFrame,
    tables: Tables,
    now: Column,
    *,
    mask: bool = True,
    enriched: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Micro-deposits: start, posting, cancel, failed attempts and lock."""
    df = enrich_deposits(ev, tables) if enriched is None else enriched
    created, updated = _new("created_timestamp"), _new("updated_timestamp")
    channel = recode_channel(_new("channel"), "deposit")
    case_id, audit_id = numeric_id("seq", "case"), numeric_id("seq", "case_audit")
    ver_id = numeric_id("seq", "verification")
    system = F.lit(str(codes.SYSTEM_AGENT))

    starts = df.filter("starts")
    updates = df.filter("op = 'U'")
    found = updates.filter("n_ver = 1")

    cases = open_cases(
        starts,
        uc_id=case_id,
        type_id=F.lit(codes.CASE_MICRO_DEPOSIT),
        status_id=codes.CASE_STATUS_MICRO_DEPOSIT,
        open_date=created,
        open_agent=system,
        status_date=updated,
        status_agent=system,
    )
    verifications = starts.select(
        ver_id.alias("bank_account_verification_id"),
        F.lit("MicroDeposit").alias("verification_type"),
        created.alias("created_date"),
        F.lit(None).cast("timestamp").alias("verified_date"),
        case_id.alias("work_case_id"),
        F.lit(codes.MICRO_DEPOSIT_AGENT).alias("agent"),
        channel.alias("channel"),
        F.lit(None).cast("string").alias("result"),
        "credit_account_id",
        F.lit(codes.MIGRATED).cast("int").alias("is_migrated"),
        F.col("bank_id").alias("bank_account_id"),
        "user_id",
    )
    deposit_rows = starts.select(
        F.lit(None).cast("timestamp").alias("canceled_date"),
        F.lit(None).cast("timestamp").alias("ach_posted_date"),
        system.alias("verification_agent"),
        channel.alias("verification_channel"),
        ver_id.alias("bank_account_verification_id"),
        F.lit(None).cast("long").alias("bank_account_verification_id_old"),
    )
    lines = expand_md(starts, ["seq", "after"], _new("mdamount1"), _new("mdamount2"))
    slot = (
        F.when(F.col("line_no") == 1, numeric_id("seq", "credit_1"))
        .when(F.col("line_no") == 2, numeric_id("seq", "credit_2"))
        .otherwise(numeric_id("seq", "debit"))
    )
    transactions = lines.select(
        slot.alias("id"),
        created.alias("created_date"),
        updated.alias("post_date"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "accounting_transaction_type",
        "status",
        updated.alias("status_update_date"),
        F.lit(None).cast("long").alias("ach_transaction_id"),
        ver_id.alias("bank_account_verification_id"),
        F.lit(None).cast("long").alias("bank_account_verification_id_old"),
    )
    map_patch = pick_one(
        starts.select(
            "modern_bank_account_id",
            _new("md_id").alias("modern_micro_deposit_id"),
            ver_id.alias("legacy_micro_deposit_id"),
            "seq",
        ).filter(F.col("modern_bank_account_id").isNotNull()),
        ["modern_bank_account_id"], [F.col("seq")], newest=True,
    )

    posted = found.filter(is_true(went("md_status", "InProgress", "Processed")))
    canceled = found.filter(
        is_true((_old("md_status") != _new("md_status")) & (_new("md_status") == "Cancel"))
    )
    key = "bank_account_verification_id"
    posting = posted.groupBy(F.col("ver_id").alias(key)).agg(
        F.max_by(updated, F.col("seq")).alias("ach_posted_date"),
        F.max("seq").alias("seq"),
    )
    cancelling = canceled.groupBy(F.col("ver_id").alias(key)).agg(
        F.max_by(updated, F.col("seq")).alias("canceled_date")
    )

    tried = found.filter(
        is_true(has_changed(["verification_attempts"]) & (_new("verification_attempts") > 0))
    )
    locks = tables["lock"].select(
        F.col("bank_account_verification_id").alias("ver_id"), F.col("id").alias("lock_id")
    )

    def make_locks(makers: DataFrame) -> DataFrame:
        return makers.select(
            numeric_id("seq", "lock").alias("lock_id"), updated.alias("open_date"), "ver_id"
        )

    tried_locked, new_locks = find_or_create(tried, locks, ["ver_id"], "seq", make_locks, "lock_id")
    attempts = tried_locked.select(
        numeric_id("seq", "attempt").alias("id"),
        F.col("lock_id").alias("verification_locking_id"),
        updated.alias("created_date"),
        F.lit(codes.MICRO_DEPOSIT_AGENT).alias("agent"),
        F.lit(codes.CHANNEL_CODES["WEB"]).alias("channel"),
    )
    attempt_events = as_events(
        tried_locked,
        event_id=assign_ids(F.col("event_id"), F.lit("attempt")),
        seq=F.col("seq"),
        op=F.lit("I"),
        origin=F.lit(MODERN),
        before=F.lit(None).cast(attempts.select(F.struct("*").alias("s")).schema["s"].dataType),
        after=F.struct(
            numeric_id("seq", "attempt").alias("id"),
            F.col("lock_id").alias("verification_locking_id"),
            updated.alias("created_date"),
            F.lit(codes.MICRO_DEPOSIT_AGENT).alias("agent"),
            F.lit(codes.CHANNEL_CODES["WEB"]).alias("channel"),
        ),
    )
    locked = found.filter(
        is_true(has_changed(["locked"]) & (_new("locked") == "1"))
    )

    def audits(rows, template, uc, audit):
        return audit_lines(
            rows, template, uc_id=uc, uc_audit_id=audit, audit_date=updated,
            account=_new("account_number"), mask=mask,
        )

    source = "modern_deposit"
    stage_id = prefixed_id(source, _new("stage_sequence_id"))
    return {
        "case": cases,
        "audit": union_all(
            [
                audits(starts, "deposit_started", case_id, audit_id),
                audits(tried, "attempt_failed", F.col("ver_case"), numeric_id("seq", "audit")),
                audits(locked, "deposit_locked", F.col("ver_case"), numeric_id("seq", "audit")),
            ]
        ),
        "verification": verifications,
        "deposit_verification": deposit_rows,
        "transaction": transactions,
        "id_map_patch": map_patch,
        "posting": posting,
        "cancelling": cancelling,
        "lock": new_locks.select(
            F.col("lock_id").alias("id"),
            "open_date",
            F.col("ver_id").alias("bank_account_verification_id"),
        ),
        "attempt": attempts,
        "attempt_events": attempt_events,
        "log": rejects(
            updates.filter("n_ver <> 1"), source, MODERN_TO_LEGACY, stage_id,
            F.when(F.col("n_ver") == 0, codes.REJECT_NO_VERIFICATION).otherwise(
                AMBIGUOUS_VERIFICATION
            ),
            now, 1,
        ),
    }


def deposit_tables(
    tables: Tables, result: dict[str, DataFrame], taken: DataFrame | None = None
) -> Tables:
    """Legacy tables after the deposit flow: new rows, then postings and cancellations.

    ``taken`` has (row_id, seq) of transactions whose image comes from a feed event: a posting
    before that event is overwritten by the image, as it would be one by one.
    """
    key = ["bank_account_verification_id"]
    txn = tables["transaction"].unionByName(result["transaction"])
    posting = result["posting"].select(
        *key,
        F.struct(
            F.col("ach_posted_date").alias("post_date"), F.lit("Processed").alias("status"), "seq"
        ).alias("_new"),
    )
    posted = txn.join(posting, key, "left")
    if taken is None:
        posted = posted.withColumn("_taken", F.lit(-1))
    else:
        last = taken.groupBy(F.col("row_id").alias("id")).agg(F.max("seq").alias("_taken"))
        posted = posted.join(last, ["id"], "left").fillna(-1, ["_taken"])
    hit = is_true(F.col("_new.seq") > F.col("_taken"))
    posted = posted.withColumns(
        {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in ("post_date", "status")}
    ).select(*txn.columns)
    checks = tables["deposit_verification"].unionByName(result["deposit_verification"])
    checks = update_from(checks, result["posting"], key, ["ach_posted_date"])
    checks = update_from(checks, result["cancelling"], key, ["canceled_date"])
    return {
        "verification": tables["verification"].unionByName(result["verification"]),
        "transaction": posted,
        "deposit_verification": checks,
        "lock": tables["lock"].unionByName(result["lock"]),
        "attempt": tables["attempt"].unionByName(result["attempt"]),
    }


def verified_versions(versions: DataFrame, patch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions with the account flow's verified dates, these as verification events).

    ``versions`` holds the other versions of the patched rows. A patch changes the row as it is before it; a row
    that isn't there then is left alone.
    """
    row = [f.name for f in schema(VERIFICATION).fields]
    key = "bank_account_verification_id"
    wanted = patch.select(key, "seq", "event_id", F.struct("verified_date", "result").alias("_new"))
    rest = [c for c in row if c != key]
    hit = enrich_as_of(wanted, versions, [key], "seq", [*rest, "there"]).filter("there")
    new = {"verified_date": F.col("_new.verified_date"), "result": F.col("_new.result")}
    after = [new.get(c, F.col(c)).alias(c) for c in row]
    events = as_events(
        hit,
        event_id=assign_ids(F.col("event_id"), F.lit("verification")),
        seq=F.col("seq"),
        op=F.lit("U"),
        origin=F.lit(MODERN),
        before=F.struct(*row),
        after=F.struct(*after),
        updated_cols=F.array(F.lit("verified_date"), F.lit("result")),
    )
    return versions.unionByName(hit.select(*after, "seq", "there")), events
