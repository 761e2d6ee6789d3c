"""Building events and tables by hand."""

from datetime import datetime

from pyspark.sql import functions as F

from duosync.plans.batch import with_empty_tables
from duosync.sources.schemas import FEEDS, TABLES, envelope, schema

NOON = datetime(2024, 7, 1, 12, 0, 0)
DAY = datetime(2024, 6, 1, 9, 0, 0)


def now():
    return F.lit(NOON.isoformat(sep=" ")).cast("timestamp")


def row(ddl, values):
    names = [f.name for f in schema(ddl).fields]
    unknown = set(values) - set(names)
    assert not unknown, unknown
    return tuple(values.get(n) for n in names)


def table(spark, name, rows):
    return spark.createDataFrame([row(TABLES[name], r) for r in rows], schema(TABLES[name]))


def tables(spark, **rows):
    return with_empty_tables(spark, {n: table(spark, n, r) for n, r in rows.items()})


def feed(spark, name, events):
    """Events are dicts with seq, op, and optional new, old, origin, cols."""
    ddl = FEEDS[name]
    data = []
    for e in events:
        data.append(
            (
                e.get("id", f"{name}-{e['seq']}"),
                e["seq"],
                e["op"],
                e.get("origin"),
                e.get("cols"),
                row(ddl, e["old"]) if "old" in e else None,
                row(ddl, e["new"]) if "new" in e else None,
            )
        )
    return spark.createDataFrame(data, envelope(ddl))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
