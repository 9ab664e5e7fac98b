"""Removal of lines that many documents share, by a sharded minimal perfect hash.

A line's key is the line without white space at its ends and with A-Z in lower case; it is hashed
to 128 bits. Spark counts the documents of every hash, with partial counts before the shuffle.
The distinct hashes that reach the threshold are dealt over shards. Each shard is a minimal
perfect hash (cascaded bit arrays: a hash alone at its place of a level keeps it, the others go
to the next level), which numbers its hashes without gaps, and two arrays under these numbers:
a fingerprint of 64 bits and the number of documents. Documents then probe the arrays with their
own line hashes, and Spark drops the lines whose count reaches the threshold. No line is joined.

A hash that the index does not hold is told by the fingerprint, which is independent of the
places, so a wrong drop needs an equal 64-bit fingerprint at the one place that is looked up.

Memory: a shard has about `SHARD_KEYS` hashes. Shards are sent to tasks in blocks of at most
`block_bytes`, a fixed bound, one block at a time; an index of several blocks takes a pass over
the documents for each, with the counts found so far kept in a written table. A line that a third
of all documents hold is one row a task before the shuffle, and no row is moved to be probed.

Defined cases: a null or empty text is one empty line; keys shorter than `least_chars` stay;
every row is a document, repeated ones too; a text of dropped lines alone becomes empty; an empty
table gives no rows; very long texts are read whole; extra columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import let, table, written

# White space that is stripped from lines, and the letters that are lowered.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Documents that must hold a line, and code points that its key must have.
LEAST_DOCUMENTS, LEAST_CHARS = 10, 1

SHARD_KEYS = 1 << 18
BLOCK_BYTES = 32 << 20

#: Places of a level for each hash that reaches it, and levels until the rest is listed.
_ROOM, _LEVELS = 2, 40


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A number below n for each of n distinct 64-bit keys, and some number or -1 for any other."""

    def __init__(self, keys: np.ndarray):
        sizes, bits, rest = [], [], keys
        while len(rest) and len(sizes) < _LEVELS:
            size = 64 * math.ceil(_ROOM * len(rest) / 64)
            places = (_mixed(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            rest = rest[~alone[places]]
        self.sizes = sizes
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.words = np.packbits(flat, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(ones, dtype=np.uint32) - ones
        #: Keys without a place of their own, in order, numbered after all others.
        self.rest = np.sort(rest)
        self.placed = int(ones.sum())

    def __len__(self) -> int:
        return self.placed + len(self.rest)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes + self.rest.nbytes

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            places = (_mixed(keys[left], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = places >> 6, (places & 63).astype(np.uint64)
            held = self.words[word]
            hit = (held >> bit) & np.uint64(1) == 1
            below = held[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            left, start = left[~hit], start + size
            if not len(left):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            same = self.rest[at] == keys[left]
            out[left[same]] = self.placed + at[same]
        return out


class Shard:
    """Counts of a set of 128-bit hashes, read through a perfect hash of their first halves."""

    def __init__(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray):
        order = np.lexsort((second, first))
        first, second, counts = first[order], second[order], counts[order]
        # Equal first halves with unlike second ones have one number: all but one are listed whole.
        again = np.zeros(len(first), bool)
        again[1:] = first[1:] == first[:-1]
        self.twins = {(int(a), int(b)): int(n) for a, b, n in zip(first[again], second[again], counts[again])}
        first, second, counts = first[~again], second[~again], counts[~again]
        self.index = PerfectHash(first)
        numbers = self.index.find(first)
        self.fingerprints = np.empty(len(first), np.uint64)
        self.fingerprints[numbers] = second
        self.counts = np.empty(len(first), np.min_scalar_type(int(counts.max(initial=0))))
        self.counts[numbers] = counts

    @property
    def nbytes(self) -> int:
        return self.index.nbytes + self.fingerprints.nbytes + self.counts.nbytes

    def probe(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Documents of each hash, 0 for hashes that are not held."""
        out = np.zeros(len(first), np.int64)
        numbers = self.index.find(first)
        found = np.flatnonzero(numbers >= 0)
        found = found[self.fingerprints[numbers[found]] == second[found]]
        out[found] = self.counts[numbers[found]]
        for (a, b), n in self.twins.items():
            out[(first == np.uint64(a)) & (second == np.uint64(b))] = n
        return out


class Block:
    """Some of the shards of an index."""

    def __init__(self, shards: dict[int, Shard], of: int):
        self.shards, self.of = shards, of

    def probe(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.int64)
        owner = first.view(np.int64) % self.of
        for number, shard in self.shards.items():
            mine = np.flatnonzero(owner == number)
            if len(mine):
                out[mine] = shard.probe(first[mine], second[mine])
        return out


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def keys_of(lines: Column) -> Column:
    """Lines as they are compared. Lowering is Spark's own for ASCII keys, letter by letter for the others."""

    def lowered(k: Column) -> Column:
        ascii_only = F.octet_length(k) == F.length(k)
        return F.when(ascii_only, F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))

    return F.transform(F.transform(lines, lambda x: F.btrim(x, F.lit(WHITE))), lowered)


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def shared_lines(docs: DataFrame, text_col: str = "text", least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(a, b, n): hash and documents of every line that enough documents hold."""
    long_enough = F.filter(keys_of(lines_of(F.col(text_col))), lambda k: F.length(k) >= least_chars)
    hashes = F.sort_array(F.transform(long_enough, _hashes))
    own = let(hashes, lambda found: F.filter(found, lambda x, k: (k == 0) | (x != F.get(found, k - 1))))
    one_a_document = docs.select(F.explode(own).alias("h")).select("h.a", "h.b")
    return one_a_document.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least_documents)


def shards_of(shared: DataFrame, shards: int) -> DataFrame:
    """(shard, size, content): the arrays of each shard, built in tasks."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, n = (rows[c].to_numpy(np.int64) for c in "abn")
        shard = Shard(a.view(np.uint64), b.view(np.uint64), n)
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "size": [shard.nbytes], "content": [pickle.dumps(shard)]})

    placed = shared.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    return placed.groupBy("shard").applyInPandas(pack, "shard int, size long, content binary")


def blocks_of(shared: DataFrame, shard_keys: int = SHARD_KEYS, block_bytes: int = BLOCK_BYTES) -> Iterator:
    """Broadcasts of all shards, at most `block_bytes` at a time (one shard at least); each is gone once the next is asked for."""
    spark = shared.sparkSession
    held = written(shared, "shared-lines")
    shards = max(1, math.ceil(held.count() / shard_keys))
    packed_shards = written(shards_of(held, shards), "line-shards")
    sizes = {r.shard: r.size for r in packed_shards.select("shard", "size").collect()}
    groups: list[list[int]] = []
    room = 0
    for shard in sorted(sizes):
        if not groups or sizes[shard] > room:
            groups.append([])
            room = block_bytes
        groups[-1].append(shard)
        room -= sizes[shard]
    for k, group in enumerate(groups):
        rows = packed_shards.where(F.col("shard").isin(group)).select("shard", "content").collect()
        block = spark.sparkContext.broadcast(Block({r.shard: pickle.loads(bytes(r.content)) for r in rows}, shards))
        yield block, k + 1 == len(groups)
        if k + 1 < len(groups):
            block.destroy()


def _probe(block):
    """Column function: documents of each line hash of a row, from the arrays of a sent block."""

    def probe(first: pa.Array, second: pa.Array) -> pa.Array:
        a, b = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in (first, second))
        offsets = first.offsets.to_numpy()
        counts = pa.array(block.value.probe(a, b), pa.int64())
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), counts)

    return F.arrow_udf(probe, "array<bigint>")


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    least_documents: int = LEAST_DOCUMENTS,
    least_chars: int = LEAST_CHARS,
    shard_keys: int = SHARD_KEYS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every row; `kept` is the text without shared lines."""
    state = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.lit(None).cast("array<bigint>").alias("held"))
    zero = F.lit(0).cast("long")
    # Keys that are too short get a hash that no shard holds.
    own = F.transform(keys_of(lines_of(F.col("text"))), lambda k: F.when(F.length(k) >= least_chars, _hashes(k)).otherwise(F.struct(zero.alias("a"), zero.alias("b"))))
    for block, last in blocks_of(shared_lines(docs, text_col, least_documents, least_chars), shard_keys, block_bytes):
        found = state.withColumn("own", own).withColumn("found", _probe(block)("own.a", "own.b"))
        held = F.when(F.col("held").isNull(), F.col("found")).otherwise(F.zip_with("held", "found", lambda a, b: F.greatest(a, b)))
        state = found.select("doc_id", "text", held.alias("held"))
        state = state if last else written(state, "line-counts")
    drop = F.transform(F.coalesce("held", F.transform("lines", lambda _: F.lit(0).cast("long"))), lambda n: n >= least_documents)
    judged = state.select("doc_id", lines_of(F.col("text")).alias("lines"), "held").select("doc_id", "lines", drop.alias("drop"))
    return judged.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("drop", lambda d: d)).cast("long").alias("n_dropped"),
        F.array_join(F.filter("lines", lambda _, k: ~F.get("drop", k)), "\n").alias("kept"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: The same result in DuckDB's SQL.
SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d
), c AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key FROM c WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE s.key IS NULL), '')) AS kept_sha256
FROM c LEFT JOIN s ON c.key = s.key
GROUP BY rid, doc_id
"""
