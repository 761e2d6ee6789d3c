"""Rows that a batch changes, as they are before each of its events.

``run_batch`` adds to the tables it hands on what is stored when it starts, under ``FIRST``, and all versions
of the rows that the batch changes, under ``VERSIONS``: a table's columns, ``seq`` (-1 for the stored
version) and ``there`` (false once the row is deleted). Without them a flow reads the tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.operators.lookup import valid_ranges

FIRST = "start:"
VERSIONS = "versions:"

Tables = dict[str, DataFrame]


def unchanged(tables: Tables, name: str, row_id: str) -> DataFrame:
    """Stored rows that the batch leaves as they are."""
    return tables[FIRST + name].join(
        tables[VERSIONS + name].select(row_id).distinct(), [row_id], "left_anti"
    )


def ranges_of(
    tables: Tables,
    name: str,
    row_id: str,
    shaped: Callable[..., DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """The rows of a table as ranges for ``during``: columns, ``_from``, ``_to`` and ``_n``.

    ``shaped`` filters a table and gives it the lookup's columns, and more that are named. Of the rows that
    stay as they are, each key keeps the last one in ``order``, and their number.
    """
    still = shaped(unchanged(tables, name, row_id))
    rest = [c for c in still.columns if c not in set(keys)]
    still = (
        still.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        .select(
            *keys, *[F.col(f"_row.{c}").alias(c) for c in rest],
            F.lit(-1).cast("long").alias("_from"), F.lit(None).cast("long").alias("_to"), "_n",
        )
    )
    changing = valid_ranges(tables[VERSIONS + name], row_id).filter("there")
    moving = shaped(changing, "_from", "_to").withColumn("_n", F.lit(1).cast("long"))
    return still.unionByName(moving)
