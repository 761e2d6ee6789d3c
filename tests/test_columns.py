import pytest
from pyspark.sql import functions as F

from duosync.functions import columns as C
from duosync.operators import generate, lookup, route


def values(spark, col, data, schema="v string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_last_four(spark):
    got = values(spark, C.last_four("v"), [("123",), ("1234",), ("123456789",), (None,)])
    assert got == ["123", "1234", "6789", None]


def test_text_takes_null_as_empty(spark):
    assert values(spark, C.text("a ", F.col("v"), " b"), [("x",), (None,)]) == ["a x b", "a  b"]


def test_account_type_else_sides(spark):
    data = [("CHK",), ("SAV",), ("?",), (None,)]
    assert values(spark, C.recode_account_type("v", "short", "long", "savings"), data) == [
        "Checking", "Savings", "Savings", "Savings",
    ]
    assert values(spark, C.recode_account_type("v", "short", "id", None), data) == [1, 2, None, None]
    with pytest.raises(ValueError):
        C.recode_account_type("v", "short", "id", "checking")


def test_channels(spark):
    data = [("AGENT",), ("CAS",), ("MOBILE",), ("WEB",), ("X",), (None,)]
    assert values(spark, C.recode_channel("v", "account"), data) == [
        "CASH", "CAS", "Mobile_App", "Web", None, None,
    ]
    assert values(spark, C.recode_channel("v", "deposit"), data)[3:] == ["Web", "X", None]


@pytest.mark.parametrize(
    ("md_rule", "date_rule", "want"),
    [
        ("strict", "classified", ("PENDING_ACH_VALIDATION", "MICRODEPOSIT", "d")),
        ("lenient", "classified", ("ACTIVE", "MICRODEPOSIT", "d")),
    ],
)
def test_classify_deposit_with_date(spark, md_rule, date_rule, want):
    df = spark.createDataFrame([("MicroDeposit", None, "d")], "verification_type string, result string, verified_date string")
    got = C.classify(df, md_rule, date_rule).collect()[0]
    assert (got.result_new, got.verification_type_new, got.verified_date_new) == want


def test_classify_unknown_type_keeps_date_only_when_asked(spark):
    df = spark.createDataFrame([("Ews", None, "d")], "verification_type string, result string, verified_date string")
    assert C.classify(df, "strict", "classified").collect()[0][3:] == (None, None, None)
    assert C.classify(df, "lenient", "always").collect()[0][3:] == (None, None, "d")


def test_local_now_follows_summer_time(spark):
    data = [("2024-07-01 12:00:00",), ("2024-01-01 12:00:00",)]
    got = values(spark, C.local_now(F.col("v").cast("timestamp")).cast("string"), data)
    assert got == ["2024-07-01 05:00:00", "2024-01-01 04:00:00"]


def test_numeric_ids_differ_and_sort_lines(spark):
    slots = list(generate.SLOTS)
    df = spark.createDataFrame([(0,), (1,), (7,)], "seq long")
    got = df.select(*[generate.numeric_id("seq", s).alias(s) for s in slots]).collect()
    flat = [v for r in got for v in r]
    assert len(set(flat)) == len(flat) and max(flat) < 0
    assert got[0].credit_1 < got[0].credit_2 < got[0].debit


def test_generated_ids_tell_their_event(spark):
    df = spark.createDataFrame([(0,), (7,), (generate.MOST_SEQ,)], "seq long")
    got = df.select("seq", *[generate.born(generate.numeric_id("seq", s)).alias(s) for s in generate.SLOTS])
    for r in got.collect():
        assert {r[s] for s in generate.SLOTS} == {r.seq}
    assert spark.range(1).select(generate.born("id")).first()[0] == -1


def test_repeated_dimension_keys_do_not_multiply_events(spark):
    ev = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    dim = spark.createDataFrame([("a", 5), ("a", 4), ("a", None), (None, 9)], "k string, v int")
    got = lookup.enrich(ev, dim, ["k"]).collect()
    assert sorted(r.n for r in got) == [1, 2, 3] and {r.n: r.v for r in got}[2] is None


def test_touching_by_named_column_and_by_difference(spark):
    ddl = "op string, updated_cols array<string>, before struct<a int, b int>, after struct<a int, b int>"
    rows = [
        ("U", ["a"], (1, 1), (1, 1)),
        ("U", ["b"], (1, 1), (2, 1)),
        ("U", None, (None, 1), (2, 1)),
        ("U", None, (1, 1), (1, 2)),
        ("I", None, None, (1, 2)),
    ]
    df = spark.createDataFrame(rows, ddl)
    got = [tuple(r.updated_cols or []) + (r.op,) for r in route.touching(df, ["a"]).collect()]
    assert got == [("a", "U"), ("U",), ("I",)]
    # Unknown counts as unchanged.
    assert route.changed(df, ["a"]).count() == 1
