"""Reading change feeds and dimensions, and pairing images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duosync.operators.lookup import any_of
from duosync.operators.ordered import running

BAD_VALUE = "BAD_VALUE"


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    stream: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A change feed as Parquet, as a batch or as a stream. The schema is never inferred."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**(options or {})).parquet(path)


def typed_changes(raw: DataFrame, row: T.StructType) -> DataFrame:
    """A feed whose ``seq`` and images are texts, with the images' types and an ``error`` column.

    ``error`` names the values that their types can't hold, and is NULL where all can; such a value
    is NULL. So one bad value costs its own event only, see ``run_batch``.
    """
    wrong = []

    def typed(field: T.StructField, text: Column, name: str) -> Column:
        value = text.try_cast(field.dataType)
        wrong.append(F.when(text.isNotNull() & value.isNull(), name))
        return value.alias(field.name)

    def image(side: str) -> Column:
        values = [typed(f, F.col(side)[f.name], f"{side}.{f.name}") for f in row.fields]
        return F.when(F.col(side).isNotNull(), F.struct(*values)).alias(side)

    number = typed(T.StructField("seq", T.LongType()), F.col("seq").cast("string"), "seq")
    images = [image("before"), image("after")]
    names = F.concat_ws(", ", *wrong)
    error = F.when(names != "", F.concat(F.lit(f"{BAD_VALUE}: "), names)).alias("error")
    return raw.select("event_id", number, "op", "origin", "updated_cols", *images, error)


def text_images(row: T.StructType) -> T.StructType:
    """The schema of such a raw feed."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in row.fields])
    names = ["event_id", "seq", "op", "origin"]
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in names]
        + [T.StructField("updated_cols", T.ArrayType(T.StringType()))]
        + [T.StructField(n, texts) for n in ("before", "after")]
    )


def read_dim(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A lookup table. Only ``columns`` are read from the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def pair_images(
    rows: DataFrame,
    keys: Sequence[str],
    seq: str,
    cols: Sequence[str] | None = None,
    *,
    width: int | None = None,
) -> DataFrame:
    """Versions of rows → events with ``before`` (the previous version, or NULL) and ``after``."""
    cols = list(cols) if cols is not None else [c for c in rows.columns if c != seq]
    out = rows.withColumn("after", F.struct(*cols))
    return running(out, keys, seq, {"before": ("last", F.col("after"))}, width=width)


def diff_snapshots(
    old: DataFrame, new: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Two snapshots → insert, update and delete events; unchanged rows are left out."""
    keys = list(keys)
    cols = new.columns
    a = old.select(*[F.col(k).alias(f"_a_{k}") for k in keys], F.struct(*cols).alias("before"))
    b = new.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.struct(*cols).alias("after"))
    before, after = F.col("before"), F.col("after")
    op = F.when(before.isNull(), "I").when(after.isNull(), "D").otherwise("U")
    changed = any_of([~before[c].eqNullSafe(after[c]) for c in cols])
    return (
        a.join(b, [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in keys], "full_outer")
        .filter(before.isNull() | after.isNull() | changed)
        .select(op.alias("op"), "before", "after")
    )


def as_events(
    df: DataFrame,
    *,
    event_id: Column,
    seq: Column,
    op: Column,
    origin: Column,
    before: Column,
    after: Column,
    updated_cols: Column | None = None,
) -> DataFrame:
    """Shape columns into the event envelope."""
    named = F.lit(None).cast("array<string>") if updated_cols is None else updated_cols
    return df.select(
        event_id.cast("string").alias("event_id"),
        seq.cast("long").alias("seq"),
        op.alias("op"),
        origin.cast("string").alias("origin"),
        named.alias("updated_cols"),
        before.alias("before"),
        after.alias("after"),
    )
