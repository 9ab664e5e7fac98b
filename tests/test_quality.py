import datetime as dt

from pyspark.sql import functions as F

from snapmart.feeds import CLICK_FEATURES
from snapmart.operators import quality

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def sample(spark):
    return spark.createDataFrame(
        [("a", 0, JAN), ("a", None, JAN), (None, 5, FEB), (None, 9, FEB)],
        "k string, v int, snapshot_date date",
    )


def by_name(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_profile_in_one_scan(spark):
    df = quality.profile(sample(spark))
    assert by_name(df) == {
        "k": ("string", 2, 0, 50.0),
        "v": ("int", 1, 1, 25.0),
        "snapshot_date": ("date", 0, 0, 0.0),
    }
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_profile_of_nothing(spark):
    df = quality.profile(sample(spark).limit(0))
    assert by_name(df)["v"] == ("int", 0, 0, None)


def test_null_and_zero_counts(spark):
    assert by_name(quality.null_counts(sample(spark))) == {"k": (2,), "v": (1,), "snapshot_date": (0,)}
    counts = quality.null_and_zero_counts(sample(spark), ["v"])
    assert by_name(counts) == {"k": (2, None), "v": (1, 1), "snapshot_date": (0, None)}


def test_describe(spark):
    row = quality.describe_numeric(sample(spark)).first()
    assert row.n == 3 and row["min"] == 0 and row["max"] == 9 and abs(row["mean"] - 14 / 3) < 1e-12
    assert abs(row.stddev - 4.509249752822894) < 1e-12


def test_null_is_one_distinct_value(spark):
    want = {"k": (2, 2), "v": (4, 0), "snapshot_date": (2, 2)}
    assert by_name(quality.duplicate_stats(sample(spark), list(want))) == want
    assert by_name(quality.duplicate_stats(sample(spark), list(want), approximate=True)) == want
    nothing = quality.duplicate_stats(sample(spark).limit(0), ["k"])
    assert by_name(nothing) == {"k": (0, 0)}


def test_click_integrity_sees_raw_text(spark):
    values = [("12.7",), ("x",), ("3",), (None,)]
    raw = spark.createDataFrame(values, "v string").select(*[F.col("v").alias(c) for c in CLICK_FEATURES])
    assert by_name(quality.click_integrity(raw)) == {c: (2, 1) for c in CLICK_FEATURES}


def test_rules_and_categories(spark):
    df = spark.createDataFrame([("Yes", 5), ("NM", 500), ("NM", None), (None, -1)], "a string, r int")
    rules = {"rate": (F.col("r") < 0) | (F.col("r") > 100), "none": F.lit(False)}
    assert by_name(quality.rule_violations(df, rules)) == {"rate": (2,), "none": (0,)}
    assert by_name(quality.values_outside(df, "a", ("Yes", "No"))) == {"NM": (2,)}
    assert by_name(quality.repeated_values(df, "a")) == {"NM": (2,)}
    assert quality.distinct_values(df, "a").count() == 3


def test_row_counts(spark):
    df = sample(spark)
    assert quality.row_count(df).first().n == 4
    got = {(r.snapshot_date, r.is_total): r.n for r in quality.rows_by_snapshot(df).collect()}
    assert got == {(JAN, 0): 2, (FEB, 0): 2, (None, 1): 4}
    got = {
        (r.domain, r.snapshot_date, r.level): r.n
        for r in quality.rows_by_domain({"x": df, "y": df.filter("v = 0")}).collect()
    }
    assert got == {
        ("x", JAN, 0): 2,
        ("x", FEB, 0): 2,
        ("y", JAN, 0): 1,
        ("x", None, 1): 4,
        ("y", None, 1): 1,
        (None, None, 3): 5,
    }


def test_null_date_is_not_the_total(spark):
    df = spark.createDataFrame([(None,), (JAN,)], "snapshot_date date")
    got = {(r.snapshot_date, r.is_total): r.n for r in quality.rows_by_snapshot(df).collect()}
    assert got == {(None, 0): 1, (JAN, 0): 1, (None, 1): 2}
