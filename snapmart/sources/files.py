"""Raw CSV feeds."""

from __future__ import annotations

import gzip
import io
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..feeds import SNAPSHOT, Feed
from ..functions.dates import among, file_snapshot
from .inference import inferred_types, typed
from .tables import found_paths, union_frames

CORRUPT = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: str | None = None,
    infer: bool = False,
    pattern: str | None = None,
    recursive: bool = False,
    keep_corrupt: bool = False,
    skip_bad_files: bool = False,
    enforce: bool = False,
) -> DataFrame:
    """Scan CSV files with a header; columns are text unless a schema is given.

    ``infer`` settles the types in one job over the text before the scan. ``keep_corrupt``
    adds the raw line of rows that do not fit the schema. ``skip_bad_files`` leaves
    unreadable or vanished files out instead of failing; without it nothing is lost
    silently. ``enforce`` takes columns by place, whatever the header says.
    """
    # Every file's header is checked, so columns cannot swap places within a scan.
    reader = spark.read.option("header", True).option("enforceSchema", enforce)
    if schema is not None:
        if keep_corrupt:
            schema = f"{schema}, `{CORRUPT}` string"
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if skip_bad_files:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    rows = reader.csv(path)
    return typed(rows, inferred_types(rows)) if infer and schema is None else rows


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias("source_file"))


READ, EMPTY, NO_ROWS, BROKEN, OTHER_HEADER = "read", "empty", "no rows", "broken", "other header"


def load_report(spark: SparkSession, path: str, columns: list[str], *, pattern: str = "*.csv*") -> DataFrame:
    """(path, length, lines, n, outcome) of every file of a folder, failing ones by name.

    A file is `read` if all of it was and its header names ``columns`` in their order;
    `empty` without a byte; `no rows` with a header alone; `broken` where it cannot be read
    to its end; `other header` where the first line names other columns. ``n`` are its data
    rows, one a line, and 0 for files that are not read. Files are looked at by tasks, and names,
    counts and reasons stay a table. Compressed files are read whole by one task, as Spark reads them.
    """
    name = F.col("_metadata.file_path")
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(name.alias("path"), "length")
    ).unionByName(spark.createDataFrame(_empty_files(spark, f"{path.rstrip('/')}/{pattern}"), "path string, length bigint"))
    text = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(path)
    header = ",".join(columns)
    found = (
        text.select(name.alias("path"), "value")
        .groupBy("path")
        .agg(F.count("*").alias("lines"), F.count_if(F.col("value") == header).alias("headers"))
    )
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(
        name.alias("packed"), F.arrow_udf(_whole_gzip, "boolean")("content").alias("whole")
    )
    files = listing.join(found, "path", "left").join(packed, F.col("path") == F.col("packed"), "left")
    lines = F.coalesce("lines", F.lit(0).cast("bigint"))
    outcome = (
        F.when(F.col("length") == 0, EMPTY)
        .when(~F.coalesce("whole", F.lit(True)) | (lines == 0), BROKEN)
        .when(F.col("headers") == 0, OTHER_HEADER)
        .when(lines == 1, NO_ROWS)
        .otherwise(READ)
    )
    judged = files.select("path", "length", lines.alias("lines"), outcome.alias("outcome"))
    n = F.when(F.col("outcome") == READ, F.col("lines") - 1).otherwise(0).cast("bigint")
    return judged.select("path", "length", "lines", n.alias("n"), "outcome")


def _empty_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Files without a byte, which scans leave out, from one listing; named as scans name files."""
    found = re.findall(r"path=([^;]+); isDirectory=false; length=0;", found_paths(spark, pattern))
    return [(re.sub(r"^(\w+):/(?!/)", r"\1:///", path), 0) for path in found]


def _whole_gzip(content: pa.Array) -> pa.Array:
    """Whether each compressed file can be read to its end, a piece at a time."""

    def whole(data: bytes) -> bool:
        try:
            with gzip.open(io.BytesIO(data)) as file:
                while file.read(1 << 20):
                    pass
        except (OSError, EOFError, zlib.error):
            return False
        return True

    return pa.array([whole(c.as_py()) for c in content], pa.bool_())


def good_rows(spark: SparkSession, path: str, columns: list[str], report: DataFrame, *, pattern: str = "*.csv*") -> DataFrame:
    """Rows of the files that a report calls `read`, as text."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = scan_csv(spark, path, schema=schema, pattern=pattern, skip_bad_files=True, enforce=True)
    read = report.filter(F.col("outcome") == READ).select(F.col("path").alias("read_path"))
    named = rows.select("*", F.col("_metadata.file_path").alias("source_path"))
    return named.join(read, F.col("source_path") == F.col("read_path"), "left_semi")


def _header_lines(spark: SparkSession, folder: str, pattern: str) -> dict[str, list[str]]:
    """First line -> files of a folder; one block of each file is read."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[str, list[str]] = {}
    for entry in store.globStatus(place) or []:
        stream = store.open(entry.getPath())
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        out.setdefault(line or "", []).append(entry.getPath().toString())
    return out


def scan_feed_files(spark: SparkSession, folder: str, feed: Feed) -> DataFrame:
    """All monthly files of a feed, dated by file name.

    Files are chosen by the feed's stem and read by their own headers: one scan for
    each distinct header, columns matched by name, absent ones null. The date in the
    name becomes the snapshot; a name without a date fails.
    """
    headers = _header_lines(spark, folder, f"*{feed.stem}*.csv")
    if not headers:
        raise FileNotFoundError(f"no file of {feed.stem} in {folder}")
    frames = []
    for paths in headers.values():
        rows = scan_csv(spark, sorted(paths))
        kept = [c for c in rows.columns if c != SNAPSHOT]
        named = rows.select(*kept, F.col("_metadata.file_name").alias("source_file"))
        frames.append(named.select(*kept, file_snapshot("source_file").alias(SNAPSHOT)))
    return union_frames(*frames)


def slice_snapshots(raw: DataFrame, dates: list) -> DataFrame:
    """Rows of the raw feed whose snapshot is one of ``dates``."""
    # ISO text equals its date, and literals of the column's type reach the scan.
    return raw.filter(among(SNAPSHOT, dates, text=dict(raw.dtypes)[SNAPSHOT] == "string"))
