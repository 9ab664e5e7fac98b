"""Credit-specific derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import found

# Patterns of the loan-type list and the credit history text.
AND_SEPARATOR = r"\s+and\s+"
ITEM_SEPARATOR = r",\s*"
YEARS_TEXT = r"(\d+)\s*Years"
MONTHS_TEXT = r"(\d+)\s*Months"


def missed_installments(overdue: Column, due: Column) -> Column:
    """Whole installments the overdue amount stands for; null when nothing was due."""
    return F.ceil(F.try_divide(overdue, due)).try_cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Due date of the oldest missed installment."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed date, 0 when nothing is overdue."""
    return F.when(overdue > 0, F.date_diff(snapshot, first_missed)).otherwise(F.lit(0))


def bad_flag(days: Column, threshold: int) -> Column:
    """1 at or above the threshold; 0 below it and for unknown days."""
    return F.when(days >= threshold, 1).otherwise(0)


def loan_items(text: Column) -> Column:
    """Loan types of a comma / "and" separated list, items untrimmed."""
    return F.split(F.regexp_replace(text, AND_SEPARATOR, ","), ITEM_SEPARATOR)


def history_months(name: str) -> Column:
    """Months of a text such as ``22 Years and 1 Months``; a missing part counts 0."""
    years, months = (
        f"coalesce(try_cast({found(name, pattern, 1)} AS INT), 0L)"
        for pattern in (YEARS_TEXT, MONTHS_TEXT)
    )
    return F.expr(f"try_cast({years} * 12 + {months} AS INT)")


def debt_to_income(debt: Column, income: Column) -> Column:
    """Debt over income; null without a positive income."""
    return F.when(income > 0, F.try_divide(debt, income))


def monthly_savings(salary: Column, installments: Column, invested: Column) -> Column:
    """Salary left after installments and investments; null if any part is."""
    return salary - installments - invested
