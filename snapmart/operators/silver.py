"""Typed, cleaned tables from raw feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..feeds import SNAPSHOT, Feed
from ..functions import credit
from ..functions.dates import iso_date
from ..functions.numbers import real_number, whole_number, zero_outside
from ..functions.text import keep_only, null_unless


def typed(name: str, source: str, target: str, *, strict: bool) -> Column:
    """Cast one column the way its feed is read."""
    if source != "string":
        return F.col(name).try_cast(target)
    if target == "int":
        return whole_number(name)
    if target == "float":
        # The ledger goes through doubles, feature files straight to floats.
        return real_number(name, "double").cast("float") if strict else real_number(name)
    return F.col(name).try_cast(target) if strict else iso_date(name)


def conform(df: DataFrame, feed: Feed) -> DataFrame:
    """Apply a feed's rules and types: keep characters, allow values, cast, limit ranges.

    Undeclared columns pass through and missing ones are skipped, except for strict
    feeds, where a missing column is an error. Each step is one projection over the
    columns it changes.
    """
    source = dict(df.dtypes)
    missing = [c for c in feed.types if c not in source]
    if feed.strict and missing:
        raise ValueError(f"{feed.table}: missing columns {missing}")

    def present(rules: dict) -> dict:
        return {c: rule for c, rule in rules.items() if c in source}

    steps = (
        {c: keep_only(F.col(c), characters) for c, characters in present(feed.keep).items()},
        {c: null_unless(F.col(c), pattern) for c, pattern in present(feed.allowed).items()},
        {
            c: typed(c, source[c], target, strict=feed.strict)
            for c, target in present(feed.types).items()
            if source[c] != target
        },
        {
            c: zero_outside(F.col(c), *bounds, fill_null=feed.range_fills_null)
            for c, bounds in present(feed.ranges).items()
        },
    )
    for changed in steps:
        if changed:
            df = df.withColumns(changed)
    return df


def with_arrears(loans: DataFrame) -> DataFrame:
    """Add month on book, missed installments, first missed date and days past due.

    Numeric nulls become 0 once the missed count is known, so an amount overdue with
    nothing due has missed count 0, no first missed date and unknown days.
    """
    counted = loans.select(
        "*",
        F.col("installment_num").cast("int").alias("mob"),
        credit.missed_installments(F.col("overdue_amt"), F.col("due_amt")).alias(
            "installments_missed"
        ),
    ).na.fill(0)
    first_missed = credit.first_missed_date(F.col(SNAPSHOT), F.col("installments_missed"))
    return counted.select("*", first_missed.alias("first_missed_date")).select(
        "*",
        credit.days_past_due(
            F.col("overdue_amt"), F.col(SNAPSHOT), F.col("first_missed_date")
        ).alias("dpd"),
    )
