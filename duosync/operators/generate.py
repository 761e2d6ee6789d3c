"""Row generators: one event becomes transactions, work cases, audit lines and history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duosync.functions import codes
from duosync.functions.columns import debit_amount, last_four, text

# Rows one event can generate. Each gets its own number within the event.
SLOTS = {
    "user": 0,
    "bank": 1,
    "case": 2,
    "case_audit": 3,
    "registration": 4,
    "registration_audit": 5,
    "verification_initial": 6,
    "verification": 7,
    "account": 8,
    "lock": 9,
    "attempt": 10,
    # Ids fall as the number rises, so this order sorts the credits before the debit.
    "debit": 11,
    "credit_2": 12,
    "credit_1": 13,
    "audit": 14,
}
SLOT_BITS = 5
# Larger event numbers would leave the range of a long; ``run_batch`` rejects such events.
MOST_SEQ = (1 << (62 - SLOT_BITS)) - 1


def assign_ids(*parts: Column | str) -> Column:
    """Text id from its parts, such as event, kind and number: unique and replay-safe."""
    return text(*[p for part in parts for p in (F.lit(":"), part)][1:])


def numeric_id(seq: Column | str, slot: str) -> Column:
    """Number id from the event's ``seq``, which is unique over all feeds.

    Such ids are negative, so they never meet one the database gave out, and a replay gives
    the same one.
    """
    c = F.col(seq) if isinstance(seq, str) else seq
    return -(F.shiftleft(c, SLOT_BITS) + F.lit(SLOTS[slot]) + F.lit(1)).cast("long")


def born(row_id: Column | str) -> Column:
    """``seq`` of the event that made a row with such an id; -1 for rows of the database."""
    c = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.when(c < 0, F.shiftright(-c - 1, SLOT_BITS)).otherwise(-1)


def dense_ids(
    df: DataFrame, order: Sequence[str], out: str, cut: Callable[[DataFrame], DataFrame], start: int = 0
) -> DataFrame:
    """Consecutive numbers from ``start + 1`` in ``order``, without one task seeing all rows.

    The rows are sorted into range partitions, as many as Spark sees fit, and written once by ``cut`` with their
    place in the partition. Only the partitions' sizes meet in one task, whose running sum moves the places
    up. A later batch goes on from its own ``start``. Rows with equal order columns are numbered in any order.
    """
    place = F.monotonically_increasing_id()
    placed = cut(df.orderBy(*order).withColumn("_place", place))
    # The id's upper part is the partition, its lower 33 bits count the partition's rows.
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return (
        placed.join(sizes, ["_part"])
        .withColumn(out, inside + F.col("_before") + F.lit(start + 1))
        .drop("_part", "_place", "_before")
    )


def expand_md(
    df: DataFrame, keep: Sequence[str], first: Column | str, second: Column | str
) -> DataFrame:
    """Two Credit rows and one Debit row of their sum, status Received, numbered by ``line_no``."""
    a = F.col(first) if isinstance(first, str) else first
    b = F.col(second) if isinstance(second, str) else second
    lines = [("Credit", a), ("Credit", b), ("Debit", debit_amount(a, b))]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("line_no"),
                F.lit(kind).alias("accounting_transaction_type"),
                value.alias("amount"),
                F.lit("Received").alias("status"),
            )
            for i, (kind, value) in enumerate(lines, 1)
        ]
    )
    return df.select(*keep, F.inline(rows))


def open_cases(
    df: DataFrame,
    *,
    uc_id: Column,
    type_id: Column,
    status_id: int = codes.CASE_STATUS_OPEN,
    ref_num: Column | str = "event_id",
    open_date: Column | str,
    open_agent: Column | str,
    status_date: Column | str,
    status_agent: Column | str,
    credit_account_id: Column | str = "credit_account_id",
    card_id: Column | str = "card_id",
) -> DataFrame:
    """Work-case rows. All cases of one event share its reference number."""

    def c(x):
        return F.col(x) if isinstance(x, str) else x

    return df.select(
        F.lit(status_id).cast("int").alias("status_id"),
        type_id.cast("int").alias("type_id"),
        c(ref_num).alias("ref_num"),
        c(open_date).alias("open_date"),
        c(open_agent).cast("string").alias("open_agent_id"),
        c(status_date).alias("status_date"),
        c(status_agent).cast("string").alias("status_agent_id"),
        uc_id.alias("uc_id"),
        c(credit_account_id).alias("credit_account_id"),
        c(card_id).alias("card_id"),
    )


def _fill(template: str, parts: dict[str, Column]) -> Column:
    pieces: list[Column | str] = []
    rest = template
    while "{" in rest:
        head, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [head, parts[name]]
    return text(*[p for p in [*pieces, rest] if not (isinstance(p, str) and p == "")])


def audit_lines(
    df: DataFrame,
    template: Column | str,
    *,
    uc_id: Column,
    uc_audit_id: Column,
    audit_date: Column | str,
    account: Column | str = "account_number",
    bank: Column | None = None,
    routing: Column | None = None,
    account_type: Column | None = None,
    mask: bool = True,
) -> DataFrame:
    """Audit rows in their fixed order, with the position as ``line_no``.

    ``template`` names an entry of ``codes.AUDIT_TEMPLATES``, or is a column of such names.
    ``mask`` shows only the last four characters of account numbers.
    """
    acct = F.col(account) if isinstance(account, str) else account
    none = F.lit(None).cast("string")
    parts = {
        "last4": last_four(acct),
        "account": last_four(acct) if mask else acct,
        "bank": none if bank is None else bank,
        "routing": none if routing is None else routing,
        "type": none if account_type is None else account_type,
    }
    if isinstance(template, str):
        lines = F.array(*[_fill(t, parts) for t in codes.AUDIT_TEMPLATES[template]])
    else:
        lines = None
        for name, texts in codes.AUDIT_TEMPLATES.items():
            filled = F.array(*[_fill(t, parts) for t in texts])
            hit = template == name
            lines = F.when(hit, filled) if lines is None else lines.when(hit, filled)
    date = F.col(audit_date) if isinstance(audit_date, str) else audit_date
    return df.select(
        uc_audit_id.alias("uc_audit_id"),
        F.lit(codes.SYSTEM_AGENT).cast("int").alias("agent_id"),
        date.alias("audit_date"),
        uc_id.alias("uc_id"),
        F.posexplode(lines).alias("_pos", "data"),
    ).select(
        "uc_audit_id",
        "agent_id",
        "data",
        "audit_date",
        "uc_id",
        (F.col("_pos") + 1).cast("int").alias("line_no"),
    )


def verification_rows(df: DataFrame, keep: Sequence[str], rows: Sequence[Column]) -> DataFrame:
    """One output row per non-null struct of ``rows``."""
    return df.select(*keep, F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def history_rows(
    df: DataFrame,
    code: int,
    *,
    customer: Column,
    account: Column,
    routing: Column,
    account_type_id: Column,
    channel: Column,
) -> DataFrame:
    """Account history: 1 insert, 2 delete, 3 update."""
    return df.select(
        "event_id",
        customer.alias("customer_id"),
        F.lit(code).cast("int").alias("change_code"),
        account.alias("account_number"),
        routing.alias("routing_number"),
        account_type_id.cast("int").alias("account_type_id"),
        channel.alias("channel"),
    )


def outbox(
    df: DataFrame,
    change_type: int,
    *,
    account_id: Column | str = "customer_bank_account_id",
    customer: Column | str = "customer_id",
) -> DataFrame:
    """One row per primary switch (3) or type change (0)."""

    def c(x):
        return F.col(x) if isinstance(x, str) else x

    return df.select(
        "event_id",
        c(account_id).alias("customer_bank_account_id"),
        c(customer).alias("customer_id"),
        F.lit(change_type).cast("int").alias("change_type"),
    )
