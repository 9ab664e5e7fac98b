"""Raw feeds to gold tables, one Spark job per table for all months."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feeds import ATTRIBUTES, CLICKSTREAM, FEATURE_KEYS, FEEDS, FINANCIALS, LOANS, SNAPSHOT, Feed
from ..functions.dates import iso_date
from ..operators import profiles
from ..operators.features import (
    feature_schema,
    feature_table,
    fill_flags,
    loan_types_by_snapshot,
    matched_feature_table,
)
from ..operators.joins import HeavyKeys, largest_buckets, surely_light
from ..operators.labels import label_table
from ..operators.silver import conform, with_arrears
from ..sources.files import scan_csv, scan_feed_files, slice_snapshots
from ..sources.states import refresh, states
from ..sources.tables import (
    ALL,
    Manifest,
    NoSnapshots,
    drop_snapshots,
    live_versions,
    manifest,
    optional_snapshots,
    partition_folders,
    read_bucketed,
    read_snapshots,
    session_settings,
    stored_dates,
    write_snapshots,
)

LABELS = "label_store"
FEATURES = "feature_store"
MATCHED_FEATURES = "feature_store_matched"
LOAN_TYPES = "loan_types"
PROFILES = "profiles"
DISTINCT = "distinct_values"
SIZES = "key_sizes"


def fingerprints(raw: DataFrame) -> dict[dt.date | None, str]:
    """Rows and sums of row hashes of every snapshot: one aggregate, one row a snapshot comes to the driver.

    Two hashes with unlike seeds are summed, so the order of rows does not matter and repeats count.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    exact = "decimal(38,0)"
    found = raw.groupBy(F.col(SNAPSHOT).cast("date").alias(SNAPSHOT)).agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(row).cast(exact)).cast("string").alias("a"),
        F.sum(F.xxhash64(F.lit(SNAPSHOT), row).cast(exact)).cast("string").alias("b"),
    )
    return {r[SNAPSHOT]: f"{r.n}:{r.a}:{r.b}" for r in found.collect()}


def _together(build, *arguments) -> list:
    """Run independent table builds as concurrent Spark jobs.

    Small feeds use the executors that the tail of a large one leaves idle.
    """
    with ThreadPoolExecutor(max_workers=len(FEEDS)) as pool:
        return list(pool.map(build, *arguments))


class Slices(Mapping):
    """Frames by (table, date); a frame is built when it is asked for."""

    def __init__(self, tables: dict[str, DataFrame], dates: list[dt.date]):
        self.tables = tables
        self.dates = dates

    def __getitem__(self, key: tuple[str, dt.date]) -> DataFrame:
        table, date = key
        if date not in self.dates:
            raise KeyError(key)
        return self.tables[table].filter(F.col(SNAPSHOT) == F.lit(date))

    def __iter__(self):
        return ((table, date) for table in self.tables for date in self.dates)

    def __len__(self) -> int:
        return len(self.tables) * len(self.dates)


class Mart:
    """Bronze, silver and gold tables under one root.

    Every build replaces the snapshots that it covers, also those that come out empty,
    and keeps all others, so a run that was cut short is repaired by running it again.
    Layers meet in tables: a gold build that
    loses an executor recomputes from silver files, not from raw text.
    """

    def __init__(
        self, spark: SparkSession, root: str, *, bronze_format: str = "parquet", buckets: int | None = None
    ):
        """``buckets`` lays silver feature feeds out by customer: gold then joins them without a shuffle."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.bronze_format = bronze_format
        self.buckets = (FEATURE_KEYS[0], buckets) if buckets else None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # Bronze: raw text, sliced by snapshot.

    def ingest(
        self, feed: Feed, raw: DataFrame | str, dates: list[dt.date] | None, *, only_changed: bool = False
    ) -> int:
        """Store the rows of the given snapshots, or of all; one scan of the source for all dates.

        ``only_changed`` first takes a fingerprint of every snapshot of the source and writes
        those alone whose fingerprint is another one than at the last such ingest.
        """
        if isinstance(raw, str):
            raw = scan_csv(self.spark, raw)
        path = self.path("bronze", feed.table)
        if dates is None and dict(raw.dtypes)[SNAPSHOT] == "string":
            raw = raw.withColumn(SNAPSHOT, iso_date(SNAPSHOT))
        rows = raw if dates is None else slice_snapshots(raw, dates)
        if not only_changed:
            return write_snapshots(rows, path, fmt=self.bronze_format, dates=ALL if dates is None else dates)
        prints = fingerprints(rows)
        known = manifest(self.spark, path) or Manifest()
        covered = set(known.versions) if dates is None else set(dates)
        changed = {d for d, p in prints.items() if known.sources.get(d) != p}
        gone = {d for d in covered & set(known.versions) if d not in prints}
        if not changed:
            drop_snapshots(self.spark, path, gone)
            return 0
        kept = {d: p for d, p in known.sources.items() if d not in gone}
        return write_snapshots(
            slice_snapshots(raw, sorted(changed, key=str)),
            path,
            fmt=self.bronze_format,
            dates=changed | gone,
            sources=kept | {d: prints[d] for d in changed},
        )

    def backfill(
        self,
        feeds: list[Feed],
        sources: list[DataFrame | str],
        dates: list[dt.date] | None,
        *,
        only_changed: bool = False,
    ) -> Slices:
        """Ingest every feed for every date, or for all that they hold; returns each slice by (table, date).

        With ``only_changed`` a second backfill writes only slices whose rows changed.
        """
        if len(feeds) != len(sources):
            raise ValueError(f"{len(feeds)} feeds but {len(sources)} sources")
        _together(lambda feed, source: self.ingest(feed, source, dates, only_changed=only_changed), feeds, sources)
        if dates is None:
            held = [live_versions(self.spark, self.path("bronze", feed.table)) for feed in feeds]
            dates = sorted({d for versions in held for d in versions if d is not None})
        return Slices({feed.table: self.bronze(feed) for feed in feeds}, dates)

    def bronze(self, feed: Feed, dates: list | None = None) -> DataFrame:
        return read_snapshots(
            self.spark, self.path("bronze", feed.table), dates=dates, fmt=self.bronze_format
        )

    # Silver: typed and cleaned.

    def build_silver(self, feed: Feed, raw: DataFrame | None = None, dates: list | None = None) -> int:
        """Clean a feed from its bronze table, or from the given raw rows.

        A build from bronze covers the given dates, or all; raw rows without dates cover
        the snapshots that they hold.
        """
        path = self.path("silver", feed.table)
        covered = dates if dates is not None or raw is not None else ALL
        try:
            rows = conform(self.bronze(feed, dates) if raw is None else raw, feed)
        except NoSnapshots:
            if dates is None:
                raise
            drop_snapshots(self.spark, path, dates)
            return 0
        if feed is LOANS:
            rows = with_arrears(rows)
        # Bronze is split by snapshot already: its files need no second shuffle.
        return write_snapshots(
            rows, path, dates=covered, rebalance=raw is not None, buckets=None if feed is LOANS else self.buckets
        )

    def build_silver_from_files(self, feed: Feed, folder: str) -> int:
        """Clean a folder of monthly files dated by their names."""
        return self.build_silver(feed, scan_feed_files(self.spark, folder, feed))

    def silver(self, feed: Feed, dates: list | None = None) -> DataFrame:
        return read_snapshots(self.spark, self.path("silver", feed.table), dates=dates)

    def silver_or_empty(self, feed: Feed, dates: list | None = None) -> DataFrame:
        return optional_snapshots(
            self.spark, self.path("silver", feed.table), feed.ddl(), dates=dates
        )

    def _side(self, feed: Feed, dates: list | None) -> DataFrame:
        """Silver rows for a join by customer, by buckets where there are some; empty if there is no table."""
        path = self.path("silver", feed.table)
        if not self.buckets or not live_versions(self.spark, path):
            return self.silver_or_empty(feed, dates)
        return read_bucketed(self.spark, path, self.buckets, dates=dates)

    def _joins_by_bucket(self):
        """Buckets of one column are enough for joins on customer and snapshot."""
        return session_settings(self.spark, spark_sql_requireAllClusterKeysForCoPartition="false")

    def _light(self, *feeds: Feed) -> HeavyKeys | None:
        """No heavy keys, if the sizes kept by snapshot rule them out; None if they must be looked for.

        The sizes of a snapshot are taken once, from its customer column. Without buckets
        the joins look for heavy keys themselves.
        """
        if not self.buckets:
            return None
        largest = []
        for feed in feeds:
            source, path = self.path("silver", feed.table), self.path(SIZES, feed.table)
            refresh(self.spark, source, path, lambda rows: largest_buckets(rows, FEATURE_KEYS, SNAPSHOT))
            kept = states(self.spark, path, f"largest bigint, {SNAPSHOT} date")
            largest.append(kept.agg(F.max("largest").alias("largest")).first().largest or 0)
        return HeavyKeys(FEATURE_KEYS) if surely_light(largest) else None

    # Gold: labels and features.

    def build_labels(self, dpd: int = 30, mob: int = 6, dates: list | None = None) -> int:
        path = self.path("gold", LABELS)
        if self._without_source(LOANS, path, dates):
            return 0
        rows = label_table(self.silver(LOANS, dates), dpd, mob)
        return write_snapshots(rows, path, dates=ALL if dates is None else dates, rebalance=False)

    def _without_source(self, feed: Feed, path: str, dates: list | None) -> bool:
        """True if a silver table has no rows at all: then the covered dates of ``path`` are removed."""
        empty = dates is not None and not partition_folders(self.spark, self.path("silver", feed.table))
        if empty:
            drop_snapshots(self.spark, path, dates)
        return empty

    def vocabulary(self) -> list[str]:
        """Loan types of all silver snapshots that a feature build has seen; empty before the first."""
        kept = states(self.spark, self.path("gold", LOAN_TYPES), f"loan string, {SNAPSHOT} date")
        return sorted(row.loan for row in kept.select("loan").distinct().collect())

    def refresh_vocabulary(self) -> list:
        """Take up the loan types of new and rewritten silver snapshots; returns these snapshots."""
        return refresh(
            self.spark, self.path("silver", FINANCIALS.table), self.path("gold", LOAN_TYPES), loan_types_by_snapshot
        )

    def build_features(self, dates: list | None = None) -> int:
        """All financial rows; attributes and clicks may be absent.

        The vocabulary spans every silver snapshot. It is kept by snapshot, so a build for one
        month reads the loan lists of snapshots that were written since the last build, not those
        of the history. A month keeps the flags it was built with; ``gold`` reads those of later
        types as 0.
        """
        path = self.path("gold", FEATURES)
        if self._without_source(FINANCIALS, path, dates):
            return 0
        self.refresh_vocabulary()
        with self._joins_by_bucket():
            return write_snapshots(self.features(dates), path, dates=ALL if dates is None else dates)

    def features(self, dates: list | None = None) -> DataFrame:
        """The feature table as a frame over silver, with the vocabulary of the last refresh."""
        return feature_table(
            *[self._side(feed, dates) for feed in (FINANCIALS, ATTRIBUTES, CLICKSTREAM)],
            vocabulary=self.vocabulary(),
            heavy=self._light(FINANCIALS, ATTRIBUTES),
        )

    # Profiles: states by snapshot, merged on demand.

    def refresh_profiles(self, feed: Feed, exact: tuple[str, ...] = ()) -> list:
        """Profile the new and rewritten silver snapshots of a feed; returns these snapshots.

        Distinct values are kept for the ``exact`` columns, sketches for all.
        """
        source = self.path("silver", feed.table)
        done = refresh(self.spark, source, self.path(PROFILES, feed.table), profiles.column_states)
        if exact:
            refresh(
                self.spark,
                source,
                self.path(DISTINCT, f"{feed.table}-{'-'.join(sorted(exact))}"),
                lambda rows: profiles.distinct_states(rows, sorted(exact)),
            )
        return done

    def profile_states(self, feed: Feed) -> DataFrame:
        return states(self.spark, self.path(PROFILES, feed.table), profiles.STATE_SCHEMA)

    def distinct_states(self, feed: Feed, exact: tuple[str, ...]) -> DataFrame:
        return states(
            self.spark, self.path(DISTINCT, f"{feed.table}-{'-'.join(sorted(exact))}"), profiles.VALUE_SCHEMA
        )

    def build_matched_features(self) -> int:
        """Customers in attributes and financials, for snapshots all three tables have.

        The common dates come from folder names and prune the scans of all three.
        """
        with self._joins_by_bucket():
            return write_snapshots(self.matched_features(), self.path("gold", MATCHED_FEATURES), dates=ALL)

    def matched_features(self) -> DataFrame:
        """The matched feature table as a frame over silver."""
        feeds = (ATTRIBUTES, FINANCIALS, CLICKSTREAM)
        dates = self.common_dates(*feeds)
        return matched_feature_table(*[self._side(f, dates) for f in feeds], heavy=self._light(ATTRIBUTES, FINANCIALS))

    def common_dates(self, *feeds: Feed) -> list[dt.date]:
        """Snapshots that every silver table has."""
        held = [stored_dates(self.spark, self.path("silver", f.table)) for f in feeds]
        return sorted(set.intersection(*map(set, held)))

    def gold(self, table: str, dates: list | None = None, *, merge_schema: bool = False) -> DataFrame:
        vocabulary = self.vocabulary() if table == FEATURES else []
        rows = read_snapshots(
            self.spark,
            self.path("gold", table),
            dates=dates,
            schema=feature_schema(vocabulary) if vocabulary else None,
            merge_schema=merge_schema,
        )
        return fill_flags(rows, vocabulary) if vocabulary else rows

    def run(
        self, sources: dict[str, DataFrame | str], dates: list[dt.date] | None, *, dpd: int = 30, mob: int = 6
    ) -> dict[str, int]:
        """Build every table from the sources, for the given snapshots or for all that they hold.

        Returns rows written per table.
        """
        feeds = [FEEDS[name] for name in sources]

        def clean(feed: Feed, source: DataFrame | str) -> tuple[int, int]:
            return self.ingest(feed, source, dates), self.build_silver(feed, dates=dates)

        rows = {}
        for feed, (raw, cleaned) in zip(feeds, _together(clean, feeds, sources.values())):
            rows[f"bronze/{feed.table}"], rows[f"silver/{feed.table}"] = raw, cleaned
        gold = {}
        if LOANS in feeds:
            gold[LABELS] = lambda: self.build_labels(dpd, mob, dates)
        if FINANCIALS in feeds:
            gold[FEATURES] = lambda: self.build_features(dates)
        counts = _together(lambda build: build(), gold.values())
        return rows | {f"gold/{name}": n for name, n in zip(gold, counts)}


__all__ = ["FEATURES", "LABELS", "MATCHED_FEATURES", "Mart", "NoSnapshots"]
