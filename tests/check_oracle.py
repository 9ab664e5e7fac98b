"""Compare every registered query with its SQL: python tests/check_oracle.py [sf_dir] [names...]."""

from __future__ import annotations

import datetime as dt
import math
import pathlib
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in records])


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str, build, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if not want:
        return "no rows"
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lost = [r for r in want if r not in set(got)][:2]
        return f"{len(got)} vs {len(want)} rows; only spark {extra}; only sql {lost}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or oracle:
        start = time.time()
        problem = compare(spark, con, sf_dir, name, queries[name], oracle[name])
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}")
    print(f"{bad} differ; without sql: {sorted(set(queries) - set(oracle))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
