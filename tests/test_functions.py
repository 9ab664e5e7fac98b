import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart.functions import credit
from snapmart.functions.dates import among, file_snapshot, iso_date, month_list
from snapmart.functions.numbers import has_fraction, outside, real_number, whole_number, zero_outside
from snapmart.functions.text import keep_only, null_unless


def one_column(spark, values, expression, ddl="v string"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r.x for r in df.select(expression.alias("x")).collect()]


def test_whole_number_follows_the_lenient_integer_cast(spark):
    cases = {
        "12": 12,
        "-12": -12,
        "+7": 7,
        "12.7": 12,
        "-12.9": -12,
        "5.": 5,
        " 8 ": 8,
        "\t8\n": 8,
        "007": 7,
        "00000000000012": 12,
        "2147483647": 2147483647,
        "-2147483648": -2147483648,
        "2147483648": None,
        "99999999999": None,
        ".5": 0,
        ".": 0,
        "-.5": 0,
        "-": None,
        "+": None,
        "": None,
        "28_": None,
        "1e3": None,
        "1.2.3": None,
        "x": None,
        None: None,
    }
    assert one_column(spark, cases, whole_number("v")) == list(cases.values())


def test_real_number_never_throws(spark):
    cases = {
        "1.5": 1.5,
        "-3": -3.0,
        ".5": 0.5,
        "5.": 5.0,
        "1e3": 1000.0,
        " 2 ": 2.0,
        "1d": 1.0,
        "Infinity": float("inf"),
        "-12--3": None,
        "1.2.3": None,
        "": None,
        "_": None,
        "-": None,
        None: None,
    }
    assert one_column(spark, cases, real_number("v")) == list(cases.values())
    assert one_column(spark, ["nan"], F.isnan(real_number("v"))) == [True]


def test_has_fraction_looks_at_the_text(spark):
    cases = {"12.7": True, "12.0": False, "12": False, "x": None, None: None}
    assert one_column(spark, cases, has_fraction("v")) == list(cases.values())


@pytest.mark.parametrize("fill,missing", [(False, None), (True, 0)])
def test_zero_outside_keeps_or_fills_null(spark, fill, missing):
    got = one_column(
        spark, [14, 15, 100, 101, -500, None], zero_outside(F.col("v"), 15, 100, fill_null=fill), "v int"
    )
    assert got == [0, 15, 100, 0, 0, missing]


def test_outside_ignores_null(spark):
    assert one_column(spark, [14, 15, None], outside(F.col("v"), 15, 100), "v int") == [True, False, None]


def test_text_rules(spark):
    ssn = null_unless(keep_only(F.col("v"), r"0-9\-"), r"^\d{3}-\d{2}-\d{4}$")
    assert one_column(spark, ["123-45-6789", "x123-45-6789_", "#F%$D@*&8", None], ssn) == [
        "123-45-6789",
        "123-45-6789",
        None,
        None,
    ]


def test_iso_date_accepts_one_form(spark):
    got = one_column(spark, ["2023-01-05", "2023-1-5", "2023-01-05 10:00:00", "2023-13-01", None], iso_date("v"))
    assert got == [dt.date(2023, 1, 5), None, None, None, None]


def test_file_snapshot(spark):
    names = ["bronze_feature_x_2024_02_01.csv"]
    assert one_column(spark, names, file_snapshot("v")) == [dt.date(2024, 2, 1)]
    assert one_column(spark, ["x.csv"], file_snapshot("v", required=False)) == [None]
    with pytest.raises(Exception, match="no snapshot date in file name x.csv"):
        one_column(spark, ["x.csv"], file_snapshot("v"))


def test_month_list(spark):
    months = month_list(spark, "2023-01-15", "2024-12-01")
    assert len(months) == 24 and months[0] == dt.date(2023, 1, 1) and months[-1] == dt.date(2024, 12, 1)
    assert month_list(spark, "2023-02-02", "2023-02-28") == [dt.date(2023, 2, 1)]
    assert month_list(spark, "2023-03-01", "2023-02-01") == []


def test_among_no_dates(spark):
    assert one_column(spark, [dt.date(2023, 1, 1)], among("v", []), "v date") == [False]


def test_loan_items_keep_blanks_and_spaces(spark):
    got = one_column(spark, ["A, and B", "B Loan ,A Loan", None], credit.loan_items(F.col("v")))
    assert got == [["A", "", "B"], ["B Loan ", "A Loan"], None]


def test_history_months(spark):
    cases = {
        "22 Years and 1 Months": 265,
        "3 Years": 36,
        "7 Months": 7,
        "5 years and 2 months": 0,
        "NA": 0,
        "99999999999 Years": 0,
        "900000000 Years": None,
        None: 0,
    }
    assert one_column(spark, cases, credit.history_months("v")) == list(cases.values())


def test_debt_to_income_needs_income(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, -2.0), (1.0, None), (None, 4.0)], "d float, i float")
    ratio = df.select(credit.debt_to_income(F.col("d"), F.col("i")).alias("x"))
    assert ratio.dtypes == [("x", "double")]
    assert [r.x for r in ratio.collect()] == [0.25, None, None, None, None]


def test_savings_null_if_any_part_is(spark):
    df = spark.createDataFrame([(10.0, 3.0, 2.0), (10.0, None, 2.0)], "a float, b float, c float")
    got = df.select(credit.monthly_savings(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()
    assert [r.x for r in got] == [5.0, None]
