"""Default labels and bad rates over the loan table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.credit import bad_flag


def label_table(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Label of every loan at one month on book."""
    return loans.filter(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        bad_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def flagged_loans(loans: DataFrame, dpd: int = 30, started_before: str = "2024-01-01") -> DataFrame:
    """Loans started before the cutoff, with a bad flag on every row."""
    return loans.filter(F.col("loan_start_date") < F.lit(started_before).cast("date")).select(
        "*", bad_flag(F.col("dpd"), dpd).alias("dpd_flag")
    )


def bad_rate_by_month(
    loans: DataFrame, dpd: int = 30, started_before: str = "2024-01-01"
) -> DataFrame:
    """Share of bad rows per month on book, in order."""
    flagged = flagged_loans(loans, dpd, started_before)
    return flagged.groupBy("mob").agg(F.avg("dpd_flag").alias("bad_rate")).orderBy("mob")


def final_rows(loans: DataFrame, installment: int = 10) -> DataFrame:
    """Rows of the last installment."""
    return loans.filter(F.col("installment_num") == installment)
