"""Derived columns: recodes, classification, masking, texts and time stamps.

Every function returns plain built-in column expressions, so they stay inside
whole-stage code generation. A comparison with NULL is unknown and takes the
``otherwise`` side, as ``F.when`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.functions import codes

DEFAULT_ZONE = "America/Los_Angeles"
CHANGE_OFFSET_MICROS = 11


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(
    df: DataFrame,
    md_rule: str,
    date_rule: str,
    *,
    verification_type: Column | str = "verification_type",
    result: Column | str = "result",
    verified_date: Column | str = "verified_date",
) -> DataFrame:
    """Add ``result_new``, ``verification_type_new`` and ``verified_date_new``.

    ``md_rule``: ``strict`` asks for ``Pass`` before a micro-deposit is ACTIVE, ``lenient``
    also accepts a verified date. ``date_rule``: ``classified`` copies the date only for
    classified rows, ``always`` copies it for every row.
    """
    if md_rule not in ("strict", "lenient") or date_rule not in ("classified", "always"):
        raise ValueError(f"unknown rule: {md_rule}, {date_rule}")
    vtype, res, vdate = _col(verification_type), _col(result), _col(verified_date)
    passed = res == "Pass"
    deposit_ok = passed if md_rule == "strict" else passed | vdate.isNotNull()
    code = (
        F.when(vtype.isin("Initial", "Ews") & passed, "EWS")
        .when(vtype == "MicroDeposit", "MICRODEPOSIT")
        .when(vtype == "Yodlee", "YODLEE")
    )
    status = (
        F.when(vtype.isin("Initial", "Ews") & passed, "ACTIVE")
        .when((vtype == "MicroDeposit") & deposit_ok, "ACTIVE")
        .when(vtype == "MicroDeposit", "PENDING_ACH_VALIDATION")
        .when((vtype == "Yodlee") & passed, "ACTIVE")
        .when(vtype == "Yodlee", "PENDING_ACH_VALIDATION")
    )
    date = vdate if date_rule == "always" else F.when(code.isNotNull(), vdate)
    return df.withColumns(
        {"result_new": status, "verification_type_new": code, "verified_date_new": date}
    )


def recode_account_type(c: Column | str, src: str, dst: str, otherwise: str | None) -> Column:
    """Translate between the account type codings of ``codes.ACCOUNT_TYPE_CODINGS``.

    ``otherwise="savings"`` sends everything but checking to savings; ``otherwise=None``
    maps both values and leaves the rest NULL.
    """
    c = _col(c)
    (src_chk, src_sav), (dst_chk, dst_sav) = (
        codes.ACCOUNT_TYPE_CODINGS[src],
        codes.ACCOUNT_TYPE_CODINGS[dst],
    )
    out = F.when(c == src_chk, F.lit(dst_chk))
    if otherwise == "savings":
        return out.otherwise(F.lit(dst_sav))
    if otherwise is None:
        return out.when(c == src_sav, F.lit(dst_sav))
    raise ValueError(f"unknown otherwise: {otherwise}")


def recode_channel(c: Column | str, variant: str) -> Column:
    """``account`` maps four codes and drops the rest; ``deposit`` maps WEB and keeps the rest."""
    c = _col(c)
    if variant == "deposit":
        return F.when(c == "WEB", F.lit(codes.CHANNEL_CODES["WEB"])).otherwise(c)
    if variant != "account":
        raise ValueError(f"unknown variant: {variant}")
    out = None
    for code, label in codes.CHANNEL_CODES.items():
        out = F.when(c == code, label) if out is None else out.when(c == code, label)
    return out


def recode_verification(
    verification_type: Column | str,
    result: Column | str,
    created: Column | str,
    verified: Column | str,
) -> dict[str, Column]:
    """Legacy type, result and verified date of a modern account's main verification row."""
    vtype, res = _col(verification_type), _col(result)
    agent_active = (vtype == "AGENT") & (res == "ACTIVE")
    kind = (
        F.when(vtype.isNull() & (res == "NEW"), "Initial")
        .when(vtype.isNull() & (res == "PENDING_ACH_VERIFICATION"), "Ews")
        .when(agent_active, "Ews")
        .when(vtype == "EWS", "Ews")
        .when(vtype == "YODLEE", "Yodlee")
        .otherwise("UnKnown")
    )
    outcome = F.when(
        vtype.isNull() & res.isin("NEW", "PENDING_ACH_VERIFICATION"), "StepUp"
    ).otherwise("Pass")
    date = F.when(agent_active, _col(created)).otherwise(_col(verified))
    return {"verification_type": kind, "result": outcome, "verified_date": date}


def last_four(c: Column | str) -> Column:
    """Last four characters; a shorter value is returned whole."""
    return F.right(_col(c), F.lit(4))


def text(*parts: Column | str | None) -> Column:
    """Concatenate, treating NULL as empty. Plain strings are literals."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts if p is not None]
    return F.concat_ws("", *cols)


def fold_case(c: Column | str) -> Column:
    return F.upper(_col(c))


def local_now(now: Column, tz: str = DEFAULT_ZONE) -> Column:
    """Wall clock of ``tz`` for the UTC instant ``now``."""
    return F.from_utc_timestamp(now, tz)


def plus_micros(c: Column | str, micros: int = CHANGE_OFFSET_MICROS) -> Column:
    return _col(c) + F.expr(f"INTERVAL '{micros / 1_000_000:.6f}' SECOND")


def stamp(
    df: DataFrame,
    now: Column,
    tz: str | None = DEFAULT_ZONE,
    offset: int = CHANGE_OFFSET_MICROS,
) -> DataFrame:
    """Add ``updated_timestamp`` (now) and ``change_timestamp`` (now plus ``offset`` µs).

    ``tz=None`` keeps the system clock. ``now`` is one literal for the whole batch.
    """
    at = now if tz is None else local_now(now, tz)
    return df.withColumns({"updated_timestamp": at, "change_timestamp": plus_micros(at, offset)})


def default_null(c: Column | str, *fallbacks) -> Column:
    """First non-null of the column and the fallbacks (columns or literals)."""
    return F.coalesce(_col(c), *[f if isinstance(f, Column) else F.lit(f) for f in fallbacks])


def debit_amount(first: Column | str, second: Column | str) -> Column:
    """Sum of the two deposits; NULL when either is NULL."""
    return _col(first) + _col(second)
