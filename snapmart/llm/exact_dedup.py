"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Texts are equal when identical after all ASCII white space is deleted. The rows are written
once to the shared folder, in parts of bounded size that stay together (a bucketed table). Each
part sends the sorted distinct fingerprints of its rows to the owners of their ranges, as
Golomb-Rice coded gaps with a mark for values that repeat inside the part. Owners see which
values come from several parts or are marked, and answer each part with a bitmap. Only rows of
marked values, the suspects, are shuffled with their texts; there the texts themselves are the
grouping keys. So unique texts never leave their part, and a text that a third of all rows
share counts once per part.

Of equal texts the row with the most code points in the original text stays, then the smallest
id (null last), then the first one written.

Defined cases: null counts as empty, and empty texts are equal to each other; a null id passes
through; rows that repeat as a whole are duplicates; an empty table gives no rows; extra
columns are kept and may have any name.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import packed, shuffle_partitions, table, unpacked, written
from snapmart.plans.workdir import scratch_path

SPACES = " \t\n\x0b\x0c\r"
#: Rows of a part, and fingerprints of an owner's range: both bound what a task holds.
PART_ROWS = 1 << 17
OWNER_ROWS = 200_000


def rice_encode(values: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """(count, width, unary bits, low bits) of sorted distinct unsigned values."""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = int(values[-1]) // len(values) if len(values) else 0
    width = max(0, mean.bit_length() - 1)
    high = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(high.sum()) + len(values), np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    low = (gaps[:, None] >> np.arange(width, dtype=np.uint64)[None, :]).astype(np.uint8) & 1
    return len(values), width, np.packbits(unary).tobytes(), np.packbits(low).tobytes()


def rice_decode(count: int, width: int, unary: bytes, low: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    high = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    bits = np.unpackbits(np.frombuffer(low, np.uint8))[: count * width].reshape(count, width).astype(np.uint64)
    rest = (bits << np.arange(width, dtype=np.uint64)[None, :]).sum(1, dtype=np.uint64) if width else np.zeros(count, np.uint64)
    return np.cumsum((high << np.uint64(width)) + rest, dtype=np.uint64)


def _owners_of(sorted_values: np.ndarray, owners: int) -> list[tuple[int, slice]]:
    """(owner, range of positions) for equal ranges of 64-bit values."""
    owner = ((sorted_values >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    cuts = np.searchsorted(owner, np.arange(owners + 1))
    return [(k, slice(int(a), int(b))) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def _send(owners: int):
    def send(part: pd.DataFrame) -> pd.DataFrame:
        values, n = np.unique(part["fp"].to_numpy(np.int64).view(np.uint64), return_counts=True)
        rows = []
        for owner, some in _owners_of(values, owners):
            start = np.uint64((owner << 32) // owners << 32)
            rows.append((owner, int(part["src"].iloc[0]), *rice_encode(values[some] - start), np.packbits(n[some] > 1).tobytes()))
        return pd.DataFrame(rows, columns=["owner", "src", "n", "width", "high", "low", "marks"])

    return send


def _answer(lists: pd.DataFrame) -> pd.DataFrame:
    """Bitmaps over each list of this owner: which values are held by several lists or marked."""
    held = [rice_decode(r.n, r.width, r.high, r.low) for r in lists.itertuples()]
    marks = [np.unpackbits(np.frombuffer(r.marks, np.uint8))[: r.n].astype(bool) for r in lists.itertuples()]
    values, n = np.unique(np.concatenate(held), return_counts=True)
    repeated = values[n > 1]
    rows = []
    for r, own, mark in zip(lists.itertuples(), held, marks):
        hit = mark | np.isin(own, repeated, assume_unique=True)
        if hit.any():
            rows.append((r.src, r.owner, np.packbits(hit).tobytes()))
    return pd.DataFrame(rows, columns=["src", "owner", "hits"])


def _receive(owners: int):
    def receive(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """One bitmap over the positions of the part's rows."""
        if not len(part) or not len(answers):
            return pd.DataFrame({"src": [], "suspects": []})
        prints = part["fp"].to_numpy(np.int64).view(np.uint64)
        values, place = np.unique(prints, return_inverse=True)
        hit = np.zeros(len(values), bool)
        by_owner = dict(zip(answers["owner"], answers["hits"]))
        for owner, some in _owners_of(values, owners):
            if owner in by_owner:
                hit[some] = np.unpackbits(np.frombuffer(by_owner[owner], np.uint8))[: some.stop - some.start]
        return _bitmap(part["src"].iloc[0], part["pos"].to_numpy()[hit[place]])

    return receive


def _bitmap(src: int, positions: np.ndarray) -> pd.DataFrame:
    flags = np.zeros(int(positions.max()) + 1 if len(positions) else 0, np.uint8)
    flags[positions] = 1
    return pd.DataFrame({"src": [src], "suspects": [np.packbits(flags, bitorder="little").tobytes()]})


def _bit(bitmap: Column, pos: Column) -> Column:
    """Bit `pos` of a binary column; false past its end or if null."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.bit_get(byte, pos % 8) != 0, F.lit(False))


def stored_parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` packed as `row` with src, pos, fp, sha and chars, written as a table bucketed by src."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    place = F.monotonically_increasing_id()
    rows = (
        packed(docs, "row")
        .select(
            "row",
            F.col(f"row.`{id_col}`").alias("own_id"),
            text.alias("text"),
            F.translate(text, SPACES, "").alias("norm"),
            place.alias("place"),
        )
        .select(
            *("row", "own_id", "text"),
            # Row numbers of a partition fill the lower 33 bits.
            F.shiftright("place", 17).alias("src"),
            F.col("place").bitwiseAND(F.lit(PART_ROWS - 1)).cast("int").alias("pos"),
            F.xxhash64("norm").alias("fp"),
            F.sha2("norm", 256).alias("sha"),
            F.length("text").alias("chars"),
        )
        .drop("text")
    )
    name = f"exact_dedup_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(shuffle_partitions(spark), "src").option(
        "path", scratch_path(spark, "exact-dedup")
    ).saveAsTable(name)
    parts = spark.table(name)
    # The frame knows its files and buckets; the session's catalog keeps no table of it.
    spark.sql(f"DROP TABLE {name}")
    return parts


def suspects(parts: DataFrame) -> DataFrame:
    """(src, suspects): a bitmap of the rows whose fingerprint occurs more than once, by part."""
    prints = parts.select("src", "pos", "fp")
    owners = max(1, -(-prints.count() // OWNER_ROWS))
    lists = prints.groupBy("src").applyInPandas(
        _send(owners), "owner int, src long, n int, width int, high binary, low binary, marks binary"
    )
    answers = lists.groupBy("owner").applyInPandas(_answer, "src long, owner int, hits binary")
    return written(
        prints.groupBy("src").cogroup(answers.groupBy("src")).applyInPandas(_receive(owners), "src long, suspects binary"),
        "exact-dedup-suspects",
    )


def verdicts(parts: DataFrame, text_col: str) -> DataFrame:
    """Every row's src, pos, own_id, sha, and keep_id, keep_src, keep_pos, group_size, kept."""
    marked = parts.join(suspects(parts).hint("shuffle_hash"), "src", "left").withColumn("suspect", _bit(F.col("suspects"), F.col("pos")))
    alone = marked.where("not suspect").select(
        "src", "pos", "own_id", "sha", F.col("own_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    held = marked.where("suspect")
    best = F.struct(
        (-F.col("chars")).alias("short"), F.col("own_id").isNull().alias("no_id"), F.col("own_id").alias("id"), "src", "pos"
    )
    norm = F.translate(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")), SPACES, "")
    groups = (
        held.withColumn("norm", norm)
        .groupBy("fp", "sha", "norm")
        .agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
        # Rows find their group by hash from here on: two texts of one SHA-256 would be an error.
        .groupBy("fp", "sha")
        .agg(F.count("*").alias("texts"), F.first("group_size").alias("group_size"), F.first("best").alias("best"))
        .withColumn("best", F.when(F.col("texts") == 1, F.col("best")).otherwise(F.raise_error(F.lit("two texts have one SHA-256"))))
        .drop("texts")
    )
    # One row a part and group goes to the join, so a large group is no larger there than its parts.
    members = held.groupBy("src", "fp", "sha").agg(F.collect_list(F.struct("pos", "own_id")).alias("members"))
    grouped = members.join(groups, ["fp", "sha"]).select("src", "sha", "best", "group_size", F.inline("members"))
    kept = (F.col("best.src") == F.col("src")) & (F.col("best.pos") == F.col("pos"))
    return alone.unionByName(
        grouped.select("src", "pos", "own_id", "sha", F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"))
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return verdicts(stored_parts(narrow, "doc_id", "text"), "text").select(
        F.col("own_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def without_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: one of each group of equal texts."""
    parts = stored_parts(docs, id_col, text_col)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return _bitmap(rows["src"].iloc[0], rows["pos"].to_numpy())

    dropped = (
        verdicts(parts, text_col).where("not kept").select("src", "pos").groupBy("src").applyInPandas(gather, "src long, suspects binary")
    )
    kept = parts.join(dropped.hint("shuffle_hash"), "src", "left").where(~_bit(F.col("suspects"), F.col("pos")))
    return unpacked(kept, "row", {}).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


#: The same result in DuckDB's SQL.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id NULLS LAST)
"""
