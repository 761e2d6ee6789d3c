"""Projections that let the test tables stand in for the domain tables.

Each text is plain SQL that Spark and DuckDB both run; ``{orders}`` and the like name the
test tables. They read whole tables; where a query needs a target and a source, or stored rows and
events, a condition on values deals the rows into those roles (named at each text).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duosync.operators.generate import MOST_SEQ

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Verifications from orders.
VER = """
SELECT o_orderkey AS id, o_custkey AS account, o_orderdate AS created_date,
  CASE substr(o_orderpriority, 1, 1)
    WHEN '1' THEN 'Initial' WHEN '2' THEN 'Ews' WHEN '3' THEN 'MicroDeposit'
    WHEN '4' THEN 'Yodlee' ELSE 'Other' END AS verification_type,
  CASE o_orderstatus WHEN 'F' THEN 'Pass' WHEN 'P' THEN 'StepUp' END AS result,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate END AS verified_date,
  CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS is_migrated
FROM {orders}
"""

# Transactions from line items. The id is unique over all verifications.
TXN = """
SELECT l_orderkey AS bank_account_verification_id,
  l_orderkey * 1000000000000 + ((l_partkey * 10 + l_linenumber) * 10000 + l_suppkey) * 100
    + CAST(l_quantity AS BIGINT) AS id,
  l_shipdate AS created_date, l_extendedprice AS amount, l_linestatus AS status,
  CASE WHEN l_returnflag = 'R' THEN 'Debit' ELSE 'Credit' END AS accounting_transaction_type,
  l_returnflag AS next_status
FROM {lineitem}
"""

# TXN's id leaves the range of a long beyond nine million orders; the same as a number of any length.
UNIT = 1_000_000_000_000
TXN_ID = "l_orderkey * 1000000000000 + ((l_partkey * 10 + l_linenumber) * 10000 + l_suppkey) * 100\
 + CAST(l_quantity AS BIGINT)"
TXN_WIDE_ID = TXN_ID.replace("l_orderkey", "CAST(l_orderkey AS DECIMAL(38, 0))")
# Event numbers of ids from here on move together if the largest would be beyond MOST_SEQ. Those below
# keep their place among the numbers of the other feeds.
TXN_DENSE = 18_000 * UNIT

# Orders as texts. Priority 4 leaves words where a number belongs, priority 5 a currency before the
# amount, pending orders an amount beyond 16 digits, and custom numbers divisible by 7 no time.
RAW_DEPOSIT = """
SELECT CAST(o_orderkey AS STRING) AS event_id, CAST(o_orderkey AS STRING) AS seq,
  CAST(o_custkey AS STRING) AS md_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN concat('USD ', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING))
    WHEN o_orderstatus = 'P' THEN concat('99999999999999999', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING))
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS mdamount1,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN substr(o_orderpriority, 3)
    ELSE substr(o_orderpriority, 1, 1) END AS verification_attempts,
  CASE WHEN o_custkey % 7 = 0 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 8), '99')
    ELSE CAST(o_orderdate AS STRING) END AS created_timestamp
FROM {orders}
"""

# Attempts from error events; a lock is a user's week.
ATTEMPT = """
SELECT event_id, user_id, date_trunc('week', ts) AS week, ts
FROM {events} WHERE event_type = 'error'
"""

# Accounts of customers: one bank account, credit account and card each.
ACCOUNT = """
SELECT c_custkey AS customer_id, c_custkey + 1000000 AS credit_account_id,
  c_custkey AS bank_account_id, concat('R', c_nationkey) AS routing_number,
  c_name AS account_number,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'Checking'
    ELSE 'Savings' END AS bank_type,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'CHK'
    ELSE 'SAV' END AS short_type,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 1 ELSE 2 END AS type_id,
  CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 1 ELSE 0 END AS is_primary,
  c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation
FROM {customer}
"""

# Target rows: customers in good standing have one, the others not.
TARGET_ACCOUNT = "SELECT * FROM (" + ACCOUNT + ") a WHERE balance >= 3000"

# Newest finished order per customer, and newest urgent one.
TGT = """
SELECT o_custkey AS customer_id, max(o_orderkey) AS order_id, count(*) AS n,
  max(o_orderdate) AS last_date
FROM {orders} WHERE o_orderstatus = 'F' GROUP BY o_custkey
"""
SRC = """
SELECT o_custkey AS customer_id, max(o_orderkey) AS order_id, count(*) AS n,
  max(o_orderdate) AS last_date
FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
"""

# Stored customer accounts of the account flow: orders that are not pending.
# Events of the same flow, one per order.
ORDER_ACCOUNT = """
SELECT o_orderkey AS n, o_custkey AS customer_id, o_custkey + 1000000 AS credit_account_id,
  concat('R', c_nationkey) AS routing_number,
  CASE WHEN o_orderkey % 7 = 0 THEN concat('', o_orderkey)
    ELSE concat('ACCT', o_orderkey) END AS account_number,
  CASE o_orderkey % 2 WHEN 0 THEN 'CHK' ELSE 'SAV' END AS account_type,
  CASE o_orderkey % 2 WHEN 0 THEN 'Checking' ELSE 'Savings' END AS bank_type,
  CASE o_orderkey % 2 WHEN 0 THEN 1 ELSE 2 END AS type_id,
  o_orderstatus, substr(o_orderpriority, 1, 1) AS priority, o_orderdate
FROM {orders} JOIN {customer} ON c_custkey = o_custkey
"""


class Data:
    """The test tables of one scale, with times as session-zone timestamps."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        # Set as a plain attribute, so each table's footer is read once.
        setattr(self, name, self._read(name))
        return self.__dict__[name]

    def _read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(
            *[
                F.col(f.name).cast("timestamp").alias(f.name)
                if isinstance(f.dataType, T.TimestampNTZType)
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    @cached_property
    def _largest_txn(self) -> int:
        """The largest id of TXN, however many digits it has."""
        return int(self.lineitem.agg(F.max(F.expr(TXN_WIDE_ID))).first()[0] or 0)

    def transactions(self) -> DataFrame:
        """TXN with ``number``, the text of an event's number, and ``seq``, its place among the events.

        While the largest id is a long and its event number at most MOST_SEQ, both are TXN's id and
        id * 4 + 3. In larger tables as many neighbouring ids share one as it takes; the order stays. That
        first joins quantities of one order, part, line number and supplier, so a key (order, line) stays one.
        """
        most, first = self._largest_txn, TXN_DENSE
        shared = most // (1 << 63) + 1
        row_id = TXN_ID if shared == 1 else f"({TXN_WIDE_ID}) div {shared}"
        wide = TXN_ID if most * 4 + 3 < 1 << 63 else TXN_WIDE_ID
        number = seq = f"({wide}) * 4 + 3"
        if most * 4 + 3 > MOST_SEQ:
            joined = (most - first) // (MOST_SEQ - first * 4 + 1) + 1
            v = TXN_ID if shared == 1 else TXN_WIDE_ID
            seq = f"""CASE WHEN {v} < {first} THEN CAST(({v}) * 4 + 3 AS BIGINT)
  ELSE {first * 4} + ({v} - {first}) div {joined} END"""
        return self.sql(f"""
SELECT l_orderkey AS bank_account_verification_id, {row_id} AS id,
  l_shipdate AS created_date, l_extendedprice AS amount, l_linestatus AS status,
  CASE WHEN l_returnflag = 'R' THEN 'Debit' ELSE 'Credit' END AS accounting_transaction_type,
  l_returnflag AS next_status, CAST({number} AS STRING) AS number, {seq} AS seq
FROM {{lineitem}}""")

    def sql(self, text: str) -> DataFrame:
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the comparison reads them; money as double."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def in_sql(text: str) -> str:
    """A stand-in text with the table names DuckDB knows."""
    return text.format(**{t: t for t in TABLES})
