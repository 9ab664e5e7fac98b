"""Column profiles that add up: states of single snapshots, merged into the profile of any set of them.

A state holds counts, moments and extremes of a column and a sketch of its distinct values.
Sums, moments and extremes merge exactly (moments up to rounding); the sketch estimates distinct
values within about `SKETCH_ERROR` (one standard error). The exact way beside it keeps the
distinct values themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..feeds import SNAPSHOT

SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

STATE_SCHEMA = (
    "column_name string, dtype string, row_count bigint, missing bigint, zeros bigint, "
    f"n bigint, mean double, m2 double, low double, high double, sketch binary, {SNAPSHOT} date"
)
VALUE_SCHEMA = f"column_name string, value string, {SNAPSHOT} date"


def _numeric(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}


def _value(column: str) -> Column:
    return F.col(column).cast("string")


def column_states(df: DataFrame) -> DataFrame:
    """One row for each snapshot and column: `STATE_SCHEMA`. One pass, with partial sums before the shuffle."""
    numeric, types = _numeric(df), dict(df.dtypes)
    nothing = F.lit(None).cast("double")
    totals, rows = [], []
    for i, c in enumerate(x for x in df.columns if x != SNAPSHOT):
        number = F.col(c).cast("double")
        measures = {"missing": F.count_if(F.col(c).isNull()), "sketch": F.hll_sketch_agg(_value(c), SKETCH_BITS)}
        if c in numeric:
            measures |= {
                "zeros": F.count_if(F.col(c) == 0),
                "n": F.count(c),
                "mean": F.avg(number),
                "m2": F.var_pop(number) * F.count(c),
                "low": F.min(number),
                "high": F.max(number),
            }
        totals += [m.alias(f"{name}_{i}") for name, m in measures.items()]
        fixed = {"zeros": F.lit(0).cast("bigint"), "n": F.lit(0).cast("bigint"), "mean": nothing, "m2": nothing, "low": nothing, "high": nothing}
        cell = lambda name: (F.col(f"{name}_{i}") if name in measures else fixed[name]).alias(name)  # noqa: E731, B023
        names = ("missing", "zeros", "n", "mean", "m2", "low", "high", "sketch")
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"), F.col("row_count"), *map(cell, names)))
    whole = df.groupBy(SNAPSHOT).agg(F.count("*").alias("row_count"), *totals)
    return whole.select(F.inline(F.array(*rows)), SNAPSHOT)


def distinct_states(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of each snapshot and column as text; null is one of them."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _value(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs), SNAPSHOT).distinct()


def merged_profile(states: DataFrame) -> DataFrame:
    """Type, missing values, zeros, percent missing and estimated distinct values (null is one) of every column."""
    values = F.hll_sketch_estimate(F.hll_union_agg("sketch")) + (F.sum("missing") > 0).cast("int")
    return states.groupBy("column_name").agg(
        F.max("dtype").alias("dtype"),
        F.sum("missing").alias("missing"),
        F.sum("zeros").alias("zeros"),
        (F.try_divide(F.sum("missing"), F.sum("row_count")) * 100).alias("pct_missing"),
        F.sum("row_count").alias("row_count"),
        values.alias("distinct_estimate"),
    )


def merged_moments(states: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every numeric column."""
    own = Window.partitionBy("column_name")
    numeric = states.filter("n > 0")
    mean = F.sum(F.col("n") * F.col("mean")).over(own) / F.sum("n").over(own)
    about = numeric.withColumn("whole", mean).withColumn("spread", F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("whole"), 2))
    return about.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.max("whole").alias("mean"),
        F.when(F.sum("n") > 1, F.sqrt(F.sum("spread") / (F.sum("n") - 1))).alias("stddev"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
    )


def merged_distinct(values: DataFrame) -> DataFrame:
    """Exact distinct values (null is one) of every column."""
    return values.select("column_name", "value").distinct().groupBy("column_name").agg(F.count("*").alias("distinct_values"))
