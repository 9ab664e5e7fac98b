"""Data quality reports. Each report is one aggregate over the table, in long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..feeds import CLICK_FEATURES, SNAPSHOT
from ..functions.numbers import has_fraction, whole_number


class _Fixed:
    """A value known without looking at the data."""

    def __init__(self, value: Column):
        self.value = value


def _report(
    df: DataFrame, measures: dict[str, dict[str, Column | _Fixed]], label: str = "column_name"
) -> DataFrame:
    """Evaluate all measures in one aggregate and return one row per name."""
    totals, rows = [], []
    for i, (name, values) in enumerate(measures.items()):
        cells = [F.lit(name).alias(label)]
        for measure, value in values.items():
            if isinstance(value, _Fixed):
                cells.append(value.value.alias(measure))
            else:
                totals.append(value.alias(f"{measure}_{i}"))
                cells.append(F.col(f"{measure}_{i}").alias(measure))
        rows.append(F.struct(*cells))
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column."""
    return _report(df, {c: {"nulls": F.count_if(F.col(c).isNull())} for c in columns or df.columns})


def null_and_zero_counts(df: DataFrame, zero_columns=CLICK_FEATURES) -> DataFrame:
    """Nulls of every column and zeros of the given ones; zeros are null elsewhere."""
    return _report(
        df,
        {
            c: {
                "nulls": F.count_if(F.col(c).isNull()),
                "zeros": F.count_if(F.col(c) == 0)
                if c in zero_columns
                else _Fixed(F.lit(None).cast("bigint")),
            }
            for c in df.columns
        },
    )


def profile(df: DataFrame) -> DataFrame:
    """Type, missing values, zeros (0 for text) and percent missing of every column."""
    types, numeric = dict(df.dtypes), set(_numeric(df))
    missing = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return _report(
        df,
        {
            c: {
                "dtype": _Fixed(F.lit(types[c])),
                "missing": missing[c],
                "zeros": F.count_if(F.col(c) == 0)
                if c in numeric
                else _Fixed(F.lit(0).cast("bigint")),
                "pct_missing": F.try_divide(missing[c], F.count("*")) * 100,
            }
            for c in df.columns
        },
    )


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum as numbers."""
    return _report(
        df,
        {
            c: {
                "n": F.count(c),
                "mean": F.avg(c),
                "stddev": F.stddev_samp(c),
                "min": F.min(c).cast("double"),
                "max": F.max(c).cast("double"),
            }
            for c in columns or _numeric(df)
        },
    )


def duplicate_stats(df: DataFrame, columns: list[str], *, approximate: bool = False) -> DataFrame:
    """Distinct values per column (null is one of them) and the rows beyond them."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct

    def measures(c: str) -> dict[str, Column]:
        values = distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))
        values = F.coalesce(values, F.lit(0)).cast("bigint")
        return {"distinct_values": values, "duplicates": F.count("*") - values}

    return _report(df, {c: measures(c) for c in columns})


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows for which each rule's predicate is true."""
    return _report(df, {r: {"violations": F.count_if(p)} for r, p in rules.items()}, "rule")


def click_integrity(raw: DataFrame, columns=CLICK_FEATURES) -> DataFrame:
    """Per feature: values with no integer reading, and numbers that are not whole.

    Takes the raw text, since after the cast no fraction is left to find. Reports
    only; rejects nothing.
    """
    return _report(
        raw,
        {
            c: {
                "unparsable": F.count_if(whole_number(c).isNull()),
                "non_integer": F.count_if(has_fraction(c)),
            }
            for c in columns
        },
    )


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts. Null counts as a value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def values_outside(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values of a category column that are not allowed, with counts; nulls excluded."""
    bad = df.filter(~F.col(column).isin(*allowed))
    return bad.groupBy(column).agg(F.count("*").alias("n"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def rows_by_snapshot(df: DataFrame) -> DataFrame:
    """Rows per snapshot plus a grand total (``is_total`` 1, no date).

    Counts are taken per snapshot first, so the rollup sees one row per month.
    """
    counts = df.groupBy(SNAPSHOT).agg(F.count("*").alias("n"))
    return counts.rollup(SNAPSHOT).agg(
        F.sum("n").alias("n"), F.grouping(SNAPSHOT).cast("int").alias("is_total")
    )


def rows_by_domain(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and snapshot, per table, and over all (``level`` 0, 1, 3)."""
    counts = [
        df.groupBy(SNAPSHOT).agg(F.count("*").alias("n")).select(F.lit(t).alias("domain"), SNAPSHOT, "n")
        for t, df in tables.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b), counts)
    return stacked.rollup("domain", SNAPSHOT).agg(
        F.sum("n").alias("n"), F.grouping_id().cast("int").alias("level")
    )
