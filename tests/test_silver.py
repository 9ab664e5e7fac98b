import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from snapmart.feeds import ATTRIBUTES, CLICKSTREAM, FINANCIALS, FINANCIALS_UNSIGNED, LOANS
from snapmart.operators.labels import bad_rate_by_month, final_rows, flagged_loans, label_table
from snapmart.operators.silver import conform, with_arrears

DAY = "2024-01-01"


def test_attributes(spark):
    raw = spark.createDataFrame(
        [
            ("1", "A", "28_", "123-45-6789", "Engineer", DAY, "kept"),
            ("2", "B", "-500", "#F%$D@*&8", "_______", "2023-1-5", "kept"),
            ("3", "C", "12.7", None, "Media Manager", DAY, "kept"),
            ("4", "D", "100", "x123-45-6789", None, DAY, "kept"),
            ("5", "E", None, "", "", None, "kept"),
        ],
        "Customer_ID string, Name string, Age string, SSN string, Occupation string, "
        "snapshot_date string, extra string",
    )
    rows = conform(raw, ATTRIBUTES).orderBy("Customer_ID").collect()
    day = dt.date(2024, 1, 1)
    assert [(r.Age, r.SSN, r.Occupation, r.snapshot_date) for r in rows] == [
        (None, "123-45-6789", "Engineer", day),
        (0, None, None, None),
        (0, None, "Media Manager", day),
        (100, "123-45-6789", None, day),
        (None, None, None, None),
    ]
    assert rows[0].extra == "kept"


def test_tolerant_feed_skips_missing_columns(spark):
    raw = spark.createDataFrame([("1", "40")], "Customer_ID string, Age string")
    assert conform(raw, ATTRIBUTES).dtypes == [("Customer_ID", "string"), ("Age", "int")]


def test_financials(spark):
    columns = ["Annual_Income", "Interest_Rate", "Num_of_Loan", "Payment_Behaviour", "Monthly_Balance"]
    raw = spark.createDataFrame(
        [
            ("1863.84_", "5318", "3_", "!@9#%8", "__-12.5__"),
            ("__10000__", "8_", "-100", "Low_spent_Small_value_payments", "-12--3"),
            ("_", "7", "4.9", None, "1.2.3"),
        ],
        ", ".join(f"{c} string" for c in columns),
    )
    rows = [tuple(r) for r in conform(raw, FINANCIALS).collect()]
    assert rows == [
        (pytest.approx(1863.84, rel=1e-6), 0, None, None, -12.5),
        (10000.0, None, -100, "Low_spent_Small_value_payments", None),
        (None, 7, 4, None, None),
    ]
    # The draft rules drop the sign and leave ranges and patterns alone.
    draft = [tuple(r) for r in conform(raw, FINANCIALS_UNSIGNED).collect()]
    assert draft[0][1:] == (5318, None, "!@9#%8", 12.5)
    assert draft[1][4] == 123.0


def test_range_may_fill_null(spark):
    raw = spark.createDataFrame([("8_",), ("101",), ("9",)], "Interest_Rate string")
    rule = replace(FINANCIALS, range_fills_null=True)
    assert [r.Interest_Rate for r in conform(raw, rule).collect()] == [0, 0, 9]


def test_clickstream_types(spark):
    raw = spark.createDataFrame([("-5", "12.7", "x", "1", DAY)], "fe_1 string, fe_2 string, fe_3 string, Customer_ID string, snapshot_date string")
    row = conform(raw, CLICKSTREAM).first()
    assert tuple(row) == (-5, 12, None, "1", dt.date(2024, 1, 1))


LOAN_ROWS = [
    # id, installment, due, overdue, snapshot
    ("paid", "6", "100.0", "0.0", "2024-03-31"),
    ("late", "6", "100.0", "150.0", "2024-03-31"),
    ("nothing due", "6", "0", "50", "2024-03-31"),
    ("negative", "6", "100", "-50", "2024-03-31"),
    ("unknown", None, None, None, "2024-03-31"),
    ("one month", "5", "100", "100", "2024-03-31"),
]


def loan_rows(spark):
    raw = spark.createDataFrame(LOAN_ROWS, "loan_id string, installment_num string, due_amt string, overdue_amt string, snapshot_date string")
    fixed = {
        "Customer_ID": "c",
        "loan_start_date": "2023-09-01",
        "tenure": "10",
        "loan_amt": "1000",
        "paid_amt": None,
        "balance": "7.5",
    }
    return raw.withColumns({k: F.lit(v).cast("string") for k, v in fixed.items()})


def test_loan_arrears(spark):
    loans = with_arrears(conform(loan_rows(spark), LOANS))
    rows = {
        r.loan_id: (r.mob, r.installments_missed, r.first_missed_date, r.dpd) for r in loans.collect()
    }
    assert rows == {
        "paid": (6, 0, None, 0),
        "late": (6, 2, dt.date(2024, 1, 31), 60),
        "nothing due": (6, 0, None, None),
        "negative": (6, 0, None, 0),
        "unknown": (0, 0, None, 0),
        "one month": (5, 1, dt.date(2024, 2, 29), 31),
    }
    filled = loans.filter("loan_id = 'unknown'").first()
    assert (filled.due_amt, filled.overdue_amt, filled.paid_amt, filled.balance) == (0, 0, 0, 7.5)
    assert dict(loans.dtypes)["due_amt"] == "float" and dict(loans.dtypes)["dpd"] == "int"


def test_amounts_are_floats_before_they_are_divided(spark):
    # 0.3 / 0.1 is below 3 as doubles and above 3 as floats.
    loans = loan_rows(spark).limit(1).withColumns({"overdue_amt": F.lit("0.3"), "due_amt": F.lit("0.1")})
    assert with_arrears(conform(loans, LOANS)).first().installments_missed == 4


def test_strict_feed_needs_every_column(spark):
    with pytest.raises(ValueError, match="tenure"):
        conform(loan_rows(spark).drop("tenure"), LOANS)


def test_labels(spark):
    loans = with_arrears(conform(loan_rows(spark), LOANS))
    labels = {r.loan_id: (r.label, r.label_def) for r in label_table(loans, dpd=30, mob=6).collect()}
    assert labels == {
        "paid": (0, "30dpd_6mob"),
        "late": (1, "30dpd_6mob"),
        "nothing due": (0, "30dpd_6mob"),
        "negative": (0, "30dpd_6mob"),
    }
    rates = [tuple(r) for r in bad_rate_by_month(loans).collect()]
    assert rates == [(0, 0.0), (5, 1.0), (6, 0.25)]
    assert flagged_loans(loans, started_before="2023-09-01").count() == 0
    assert final_rows(loans, 5).count() == 1 and final_rows(loans).count() == 0
