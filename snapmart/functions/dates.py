"""Snapshot dates and the month calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbers import found

# Date formats of the feeds.
ISO_DATE = "yyyy-MM-dd"
ISO_DATE_TEXT = r"^[+-]?\d{4,}-\d{2}-\d{2}$"
FILE_DATE = "yyyy_MM_dd"
FILE_DATE_TEXT = r"(\d{4}_\d{2}_\d{2})"


def iso_date(name: str) -> Column:
    """Date of a ``yyyy-MM-dd`` text column; null for any other form."""
    return F.expr(f"try_to_date({found(name, ISO_DATE_TEXT)}, '{ISO_DATE}')")


def file_snapshot(name: str, *, required: bool = True) -> Column:
    """Snapshot date in a column of file names (``..._2024_01_01.csv``).

    A name without a date fails the job unless ``required`` is false.
    """
    date = F.expr(f"try_to_date({found(name, FILE_DATE_TEXT, 1)}, '{FILE_DATE}')")
    if not required:
        return date
    problem = F.raise_error(F.concat(F.lit("no snapshot date in file name "), F.col(name)))
    return F.coalesce(date, problem.cast("date"))


def among(name: str, dates: list[dt.date | None], *, text: bool = False) -> Column:
    """True for the given dates, with None for rows without one; ``text`` compares ISO strings."""
    literals = ", ".join(f"{'' if text else 'DATE'}'{date}'" for date in dates if date is not None)
    chosen = F.expr(f"`{name}` IN ({literals})") if literals else F.lit(False)
    return chosen | F.col(name).isNull() if None in dates else chosen


def month_starts(start: Column, end: Column) -> Column:
    """Array of the first days of all months from start's month up to ``end``.

    Null when the range is empty.
    """
    first = F.trunc(start, "MM")
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))


def month_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month between two dates."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return bounds.select(F.explode(month_starts(F.col("start"), F.col("end"))).alias("snapshot_date"))


def month_list(spark: SparkSession, start: str, end: str) -> list[dt.date]:
    """The calendar as Python dates, for use as filter literals."""
    return [row.snapshot_date for row in month_calendar(spark, start, end).collect()]
