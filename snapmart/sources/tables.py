"""Tables partitioned by snapshot date, read through a manifest.

A write puts its rows into new folders, ``snapshot_date=.../snapshot_version=...``, which no
reader knows yet. Then one manifest, a list of the live version of every snapshot, replaces the
former one by a rename. Readers take the newest manifest, so they see all of a write or nothing
of it, and a write that dies between the two steps changes nothing. Folders without a manifest
are read as plain partitioned tables.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..feeds import SNAPSHOT
from ..functions.dates import among

_NO_DATA = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}

VERSION = "snapshot_version"
MANIFESTS = "_manifests"

#: Former manifests whose folders stay, for readers that planned before the last switch.
KEPT_MANIFESTS = 1

#: Snapshot folders up to which the driver lists them itself.
LISTED_HERE = 128

#: A write that covers all snapshots of its table.
ALL = "all"


class NoSnapshots(FileNotFoundError):
    """A table that must exist has no data."""


class BucketDrift(ValueError):
    """A write or read asks for other buckets than those in which a table's rows lie."""


class ConcurrentWrite(RuntimeError):
    """Another write of the same table was finished first; its result stands."""


@dataclass(frozen=True)
class Manifest:
    """Live version of every snapshot; None is the snapshot of rows without a date.

    ``sources`` are the versions of another table from which snapshots were derived, ``buckets``
    the column and number of the buckets in which rows lie, if they do.
    """

    number: int = 0
    versions: dict[dt.date | None, str] = field(default_factory=dict)
    sources: dict[dt.date | None, str] = field(default_factory=dict)
    buckets: tuple[str, int] | None = None

    def text(self) -> str:
        def named(versions: dict) -> dict[str, str]:
            return {"" if d is None else d.isoformat(): v for d, v in versions.items()}

        return json.dumps({"versions": named(self.versions), "sources": named(self.sources), "buckets": self.buckets})

    @staticmethod
    def of(number: int, text: str) -> Manifest:
        def dated(versions: dict) -> dict[dt.date | None, str]:
            return {dt.date.fromisoformat(d) if d else None: v for d, v in versions.items()}

        content = json.loads(text)
        buckets = tuple(content["buckets"]) if content.get("buckets") else None
        return Manifest(number, dated(content["versions"]), dated(content["sources"]), buckets)


def _folder(spark: SparkSession, path: str):
    """File system and path object of a folder, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def found_paths(spark: SparkSession, pattern: str) -> str:
    """Text with the paths that a pattern matches: one listing, one answer, however many there are."""
    files, place = _folder(spark, pattern)
    matched = files.globStatus(place)
    return spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(matched) if matched else ""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in set(re.findall(r"/(\d{10})\.json", found_paths(spark, f"{path}/{MANIFESTS}/*.json"))))


def _read_manifest(spark: SparkSession, path: str, number: int) -> Manifest:
    files, place = _folder(spark, f"{path}/{MANIFESTS}/{number:010d}.json")
    stream = files.open(place)
    try:
        return Manifest.of(number, spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest; none for a plain folder."""
    numbers = _numbers(spark, path)
    return _read_manifest(spark, path, numbers[-1]) if numbers else None


def commit(spark: SparkSession, path: str, new: Manifest) -> None:
    """Make a manifest the newest one, unless another one has its number by now."""
    jvm = spark._jvm
    files, staged = _folder(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = files.create(staged)
    try:
        stream.write(bytearray(new.text().encode()))
    finally:
        stream.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{new.number:010d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(staged, place, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError as problem:
        files.delete(staged, False)
        if "FileAlreadyExists" in str(problem.java_exception):
            raise ConcurrentWrite(f"{path}: manifest {new.number} exists") from problem
        raise


def _version_folder(path: str, date: dt.date | None, version: str) -> str:
    return f"{path}/{SNAPSHOT}={'__HIVE_DEFAULT_PARTITION__' if date is None else date}/{VERSION}={version}"


def _expire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove older manifests, and the folders that only these name."""
    numbers = _numbers(spark, path)
    old, kept = numbers[: -keep - 1], numbers[-keep - 1 :]
    if not old:
        return
    live = {pair for n in kept for pair in _read_manifest(spark, path, n).versions.items()}
    for number in old:
        for pair in _read_manifest(spark, path, number).versions.items():
            if pair not in live:
                files, folder = _folder(spark, _version_folder(path, *pair))
                files.delete(folder, True)
        files, place = _folder(spark, f"{path}/{MANIFESTS}/{number:010d}.json")
        files.delete(place, False)


def remove_orphans(spark: SparkSession, path: str) -> int:
    """Remove folders that no manifest names, which writes that died left; no write may be running."""
    named = {pair for n in _numbers(spark, path) for pair in _read_manifest(spark, path, n).versions.items()}
    orphans = _versions_in(found_paths(spark, f"{path}/{SNAPSHOT}=*/{VERSION}=*")) - named if named else set()
    for pair in orphans:
        files, folder = _folder(spark, _version_folder(path, *pair))
        files.delete(folder, True)
    return len(orphans)


def _versions_in(listing: str) -> set[tuple[dt.date | None, str]]:
    found = re.findall(rf"{SNAPSHOT}=([^/]+)/{VERSION}=(\w+)", listing)
    return {(None if d.startswith("__HIVE") else dt.date.fromisoformat(d), v) for d, v in found}


def partition_folders(spark: SparkSession, path: str) -> dict[dt.date | None, str]:
    """Snapshot date -> folder of its live rows; None is the folder of rows without a date. No data file is opened."""
    known = manifest(spark, path)
    if known is not None:
        return {d: _version_folder(path, d, v) for d, v in known.versions.items()}
    found = set(re.findall(rf"/{SNAPSHOT}=([^/;,\]]+)", found_paths(spark, f"{path}/{SNAPSHOT}=*")))
    return {None if d.startswith("__HIVE") else dt.date.fromisoformat(d): f"{path}/{SNAPSHOT}={d}" for d in found}


def live_versions(spark: SparkSession, path: str) -> dict[dt.date | None, str]:
    """Version of every snapshot: it changes with every write of the snapshot."""
    known = manifest(spark, path)
    return dict(known.versions) if known else {}


def write_snapshots(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    dates: list | str | None = None,
    rebalance: bool = True,
    max_records_per_file: int = 0,
    sources: dict[dt.date | None, str] | None = None,
    buckets: tuple[str, int] | None = None,
) -> int:
    """Replace the snapshots present in ``df``; return the row count.

    ``dates`` are the snapshots that the write covers, or ``ALL``: of these, the ones
    that got no row are no longer in the table. All others are kept.

    Rows are rebalanced on the snapshot: small months share a task and a large one is
    split into files of the advisory partition size, so neither a month nor a task
    grows with the data. The count is taken while writing, not in a second pass.
    Writing the same rows again leaves the table's rows unchanged. The calls of the
    driver do not grow with the months, but for folders that are removed after a switch.

    ``buckets``, a column and a number, puts equal values of the column into one bucket, so
    that joins on it need no shuffle (``read_bucketed``). A table keeps its buckets.
    """
    spark = df.sparkSession
    before = _as_manifest(spark, path)
    if before.number and before.buckets != buckets:
        raise BucketDrift(f"{path} has buckets {before.buckets}, not {buckets}")
    version = f"v{uuid.uuid4().hex}"
    counted = Observation()
    if buckets:
        # Spark's own bucket of a row: a task has few buckets, and a hot one is dealt over several tasks.
        bucket = F.pmod(F.hash(buckets[0]), F.lit(buckets[1]))
        df = df.withColumn("_bucket", bucket).hint("rebalance", F.col("_bucket")).drop("_bucket")
    rows = df.hint("rebalance", F.col(SNAPSHOT)) if rebalance and not buckets else df
    # Counted in the writing stage: a map stage repeated after an executor loss
    # would be counted twice.
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(VERSION, F.lit(version))
    if buckets:
        own = [c for c in rows.columns if c not in (SNAPSHOT, VERSION)]
        with _bucketed_table(spark, path, rows.select(*own, SNAPSHOT), buckets) as name:
            rows.select(*own, SNAPSHOT, VERSION).write.insertInto(name)
    else:
        writer = (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(SNAPSHOT, VERSION)
        )
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(path)
    new = {d: v for d, v in _versions_in(found_paths(spark, f"{path}/{SNAPSHOT}=*/{VERSION}={version}"))}
    covered = set(before.versions) if dates == ALL else set(dates or ())
    kept = {d: v for d, v in before.versions.items() if d not in covered and d not in new}
    if sources is None:
        sources = {d: v for d, v in before.sources.items() if d not in covered and d not in new}
    commit(spark, path, Manifest(before.number + 1, kept | new, sources, buckets))
    _expire(spark, path, KEPT_MANIFESTS)
    return counted.get["rows"]


_SETTING = threading.RLock()


@contextmanager
def session_settings(spark: SparkSession, **settings: str):
    """Settings of the session while a plan is made and run; names have _ for the dot.

    Builds run in threads of one session, so one at a time may change its settings.
    """
    names = {name: name.replace("_", ".") for name in settings}
    with _SETTING:
        old = {name: spark.conf.get(names[name], None) for name in settings}
        for name, value in settings.items():
            spark.conf.set(names[name], value)
        try:
            yield
        finally:
            for name, value in old.items():
                spark.conf.unset(names[name]) if value is None else spark.conf.set(names[name], value)


@contextmanager
def _bucketed_table(spark: SparkSession, path: str, df: DataFrame, buckets: tuple[str, int]):
    """Name of a table over a folder, in the session's catalog for a moment: only tables have buckets."""
    name = f"snapmart_{uuid.uuid4().hex}"
    types = {f.name: f.dataType.simpleString() for f in df.schema} | {VERSION: "string"}
    columns = ", ".join(f"`{c}` {t}" for c, t in types.items())
    with session_settings(spark, spark_sql_hive_manageFilesourcePartitions="false"):
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{SNAPSHOT}`, `{VERSION}`) "
            f"CLUSTERED BY (`{buckets[0]}`) INTO {buckets[1]} BUCKETS LOCATION '{path}'"
        )
    try:
        yield name
    finally:
        # The table lies elsewhere: its files stay.
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, path: str, buckets: tuple[str, int], *, dates: list | None = None) -> DataFrame:
    """Scan a table by its buckets: joins and groups on their column need no shuffle of it."""
    known = manifest(spark, path)
    if known is None or not known.versions:
        raise NoSnapshots(f"no snapshots under {path}")
    if known.buckets != buckets:
        raise BucketDrift(f"{path} has buckets {known.buckets}, not {buckets}")
    plain = read_snapshots(spark, path)
    with _bucketed_table(spark, path, plain, buckets) as name:
        table = spark.table(name)
    wanted = [d for d in known.versions if dates is None or d in set(dates)]
    live = [
        (F.col(SNAPSHOT).isNull() if d is None else F.col(SNAPSHOT) == F.lit(d)) & (F.col(VERSION) == known.versions[d]) for d in wanted
    ]
    return table.filter(reduce(lambda a, b: a | b, live, F.lit(False))).select(*plain.columns)


def _as_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest, or an empty one for a new table."""
    known = manifest(spark, path)
    if known is None and partition_folders(spark, path):
        raise ValueError(f"{path} holds snapshots but no manifest: write them to a new table")
    return known or Manifest()


def drop_snapshots(spark: SparkSession, path: str, dates: Iterable) -> None:
    """Take the given snapshots out of a table."""
    known = manifest(spark, path)
    gone = set(dates)
    if known is not None and gone & {*known.versions, *known.sources}:
        versions, sources = ({d: v for d, v in held.items() if d not in gone} for held in (known.versions, known.sources))
        commit(spark, path, Manifest(known.number + 1, versions, sources, known.buckets))
        _expire(spark, path, KEPT_MANIFESTS)


def read_snapshots(
    spark: SparkSession,
    path: str,
    *,
    dates: list | None = None,
    schema: str | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """Scan a snapshot table, all of it or only the given dates.

    Only folders of the wanted dates are listed, and a date filter prunes partitions.
    ``merge_schema`` reads every footer, so it is off; a given ``schema`` does the same
    for tables whose months differ in their columns.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    elif merge_schema:
        reader = reader.option("mergeSchema", True)
    known = manifest(spark, path)
    if known is not None and not known.versions:
        raise NoSnapshots(f"no snapshots under {path}")
    try:
        if known is None:
            table = reader.load(path)
        else:
            wanted = [d for d in known.versions if dates is None or d in set(dates)] or [next(iter(known.versions))]
            folders = [_version_folder(path, d, known.versions[d]) for d in wanted]
            # A job for the listing pays off for many folders only.
            with session_settings(spark, spark_sql_sources_parallelPartitionDiscovery_threshold=str(LISTED_HERE)):
                table = reader.option("basePath", path).load(folders).drop(VERSION)
    except AnalysisException as problem:
        if problem.getCondition() in _NO_DATA:
            raise NoSnapshots(f"no snapshots under {path}") from problem
        raise
    if dict(table.dtypes)[SNAPSHOT] != "date":
        table = table.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
    return table if dates is None else table.filter(among(SNAPSHOT, dates))


def optional_snapshots(
    spark: SparkSession, path: str, schema: str, *, dates: list | None = None
) -> DataFrame:
    """The table, or an empty frame of the given schema when it does not exist."""
    try:
        if exists(spark, path):
            return read_snapshots(spark, path, dates=dates)
    except NoSnapshots:
        pass
    return spark.createDataFrame([], schema)


def snapshot_dates(table: DataFrame) -> DataFrame:
    """Distinct snapshot dates of any frame."""
    return table.select(SNAPSHOT).distinct()


def stored_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Snapshot dates of a table from its folder names: no file is opened."""
    dates = sorted(d for d in partition_folders(spark, path) if d is not None)
    if not dates:
        raise NoSnapshots(f"no snapshots under {path}")
    return dates


def date_frame(spark: SparkSession, dates: list[dt.date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], f"{SNAPSHOT} date")


def latest_snapshot(table: DataFrame) -> DataFrame:
    """Rows of the newest snapshot; the date is a subquery that prunes partitions."""
    newest = table.agg(F.max(SNAPSHOT)).scalar()
    return table.filter(F.col(SNAPSHOT) == newest)


def common_snapshots(*tables: DataFrame) -> DataFrame:
    """Snapshot dates present in every table; only distinct dates are compared."""
    return reduce(lambda a, b: a.intersect(b), [snapshot_dates(t) for t in tables])


def preview(table: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a fixed order, of all rows."""
    return table.orderBy(*order).limit(rows)


def first_file(spark: SparkSession, path: str, date: dt.date | None = None) -> str:
    """First data file by name of a snapshot, the newest one if none is given; one folder is listed."""
    folders = partition_folders(spark, path)
    dated = [d for d in folders if d is not None]
    if not folders or (date is not None and date not in folders):
        raise NoSnapshots(f"no snapshot {date or ''} under {path}")
    folder = folders[date if date is not None else max(dated, default=None)]
    names = sorted(set(re.findall(r"/(part-[^/;,\]]+)", found_paths(spark, f"{folder}/part-*"))))
    if not names:
        raise NoSnapshots(f"no file in {folder}")
    return f"{folder}/{names[0]}"


def preview_file(
    spark: SparkSession, path: str, order: list[str], rows: int = 5, *, date: dt.date | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The first rows of the first file of a snapshot: a look at a table of any size that reads one file."""
    reader = spark.read.format(fmt).option("basePath", path)
    if fmt == "csv":
        reader = reader.option("header", True)
    table = reader.load(first_file(spark, path, date))
    return preview(table.drop(VERSION), order, rows)


def union_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
