"""Small tables with one state a snapshot, derived from a snapshot table and kept up to date.

The manifest of a state table records from which version of each source snapshot its state was
made. A refresh reads only the snapshots whose version is another one by now, so a new month
costs a scan of that month, whatever the length of the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import Manifest, drop_snapshots, live_versions, manifest, read_snapshots, write_snapshots


def stale_snapshots(spark: SparkSession, source: str, path: str) -> tuple[list, list]:
    """Snapshots of the source whose state is missing or out of date, and states whose snapshot is gone."""
    live = live_versions(spark, source)
    known = (manifest(spark, path) or Manifest()).sources
    return [d for d in live if known.get(d) != live[d]], [d for d in known if d not in live]


def refresh(
    spark: SparkSession, source: str, path: str, build: Callable[[DataFrame], DataFrame]
) -> list[dt.date | None]:
    """Build the states of new and rewritten snapshots; returns these snapshots.

    ``build`` takes the rows of some snapshots and returns rows that carry their snapshot date.
    """
    stale, gone = stale_snapshots(spark, source, path)
    if stale:
        live = live_versions(spark, source)
        known = (manifest(spark, path) or Manifest()).sources
        # Versions as they were when the rows were chosen: a later write makes the state stale again.
        made = {d: v for d, v in known.items() if d in live} | {d: live[d] for d in stale}
        rows = build(read_snapshots(spark, source, dates=stale))
        write_snapshots(rows, path, dates=[*stale, *gone], sources=made)
    elif gone:
        drop_snapshots(spark, path, gone)
    return stale


def states(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All states; none if nothing was built yet."""
    known = manifest(spark, path)
    if known is None or not known.versions:
        return spark.createDataFrame([], schema)
    return read_snapshots(spark, path, schema=schema)
