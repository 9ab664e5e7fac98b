"""Small helpers that the operators of this package share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.plans.workdir import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: later reads do not recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys that `join_hot` broadcasts at most, and rows of a key that stay together in any case.
HOT_KEYS, ROWS_OF_KEY = 200_000, 500


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, how: str = "inner") -> DataFrame:
    """`left` joined (inner or left) with `right`, which has one row a key and in `rows` how many rows of `left` hold it.

    Keys with more rows than a share of the `total` are at most `HOT_KEYS`. They meet `left` where
    it lies, by a broadcast of their rows of `right`; all other keys are shuffled. A null key is none.
    """
    limit = max(ROWS_OF_KEY, total // HOT_KEYS)
    hot, rest = right.where(F.col(rows) > limit).drop(rows), right.where(F.col(rows) <= limit).drop(rows)
    others = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key, how)
    return left.join(F.broadcast(hot), key).unionByName(others)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, name: str) -> DataFrame:
    """All columns as one struct, so that working columns cannot clash with them."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name))


def unpacked(df: DataFrame, name: str, added: dict[str, Column]) -> DataFrame:
    """The packed columns, then the added ones; an input column of an added name is replaced."""
    fields = [f.name for f in df.schema[name].dataType if f.name.lower() not in {a.lower() for a in added}]
    return df.select(*[F.col(f"{name}.`{f}`").alias(f) for f in fields], *[c.alias(a) for a, c in added.items()])


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash: maps and variants cannot be."""
    return [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
