"""Uniform sharding with exact shard sizes through a hypergeometric communication matrix.

Rows fall by a hash of their key into buckets. The matrix says how many rows each bucket
sends to each shard: its rows are drawn one after the other from the multivariate
hypergeometric distribution, given the bucket sizes and the exact shard sizes. In a bucket
the rows are permuted and dealt out as its matrix row says, and in a shard they are permuted
again, block by block, which gives their slots. All draws come from hashes of the seed, so a
repeated task deals alike. Only DataFrame functions are used.

Defined cases: null keys and texts are values like others; an empty table gives no rows; rows
that are alike in all key columns share a hash, so they meet in one bucket and are dealt in
any order, which cannot be seen in the result. Pass `row_key` columns that tell rows apart
(such as a file's name and row number) where many rows may be alike. An input column called
like an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import hashable, let, packed, shuffle_partitions, table, unpacked

#: Rows that a bucket or block of the two permutations should hold.
ROWS_PER_BUCKET = 50_000
SHARDS = 8


def _uniform(*parts: Column) -> Column:
    """A double in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def hypergeometric(draws: Column, good: Column, total: Column, u: Column) -> Column:
    """How many of `good` among `total` items are among `draws` items taken without return.

    Inversion from the mode outwards: weights follow from the ratio of neighbours, are summed
    first, and `u` times the sum says where the walk stops. The walk covers ten standard
    deviations to either side, beyond which a double holds no weight.
    """

    def walk(n, k, t, start, target):
        steps = F.least(
            F.ceil(10 * F.sqrt(n * k / t * (1 - k / t) * (t - n) / F.greatest(t - 1, F.lit(1.0)))) + 25,
            F.greatest(F.least(n, k) - start, start - F.greatest(F.lit(0.0), n + k - t)),
        ).cast("int")
        first = F.struct(
            F.lit(1.0).alias("up"), F.lit(1.0).alias("down"), F.lit(1.0).alias("sum"),
            F.when(target < 1.0, start).alias("found"),
        )

        def step(a, i):
            x, y = start + i, start - i
            up = F.when(x <= F.least(n, k), a.up * (k - x + 1) * (n - x + 1) / (x * (t - k - n + x))).otherwise(0.0)
            down = F.when(
                y >= F.greatest(F.lit(0.0), n + k - t), a.down * (y + 1) * (t - k - n + y + 1) / ((k - y) * (n - y))
            ).otherwise(0.0)
            return let(
                F.struct(up.alias("up"), down.alias("down")),
                lambda w: F.struct(
                    w.up.alias("up"),
                    w.down.alias("down"),
                    (a.sum + w.up + w.down).alias("sum"),
                    F.coalesce(
                        a.found,
                        F.when(target < a.sum + w.up, x).when(target < a.sum + w.up + w.down, y),
                    ).alias("found"),
                ),
            )

        return F.when(steps >= 1, F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), first, step)).otherwise(first)

    def draw(v):
        n, k, t, start = v.n, v.k, v.t, v.mode
        return let(
            walk(n, k, t, start, F.lit(float("inf"))).sum * v.u,
            lambda target: F.coalesce(walk(n, k, t, start, target).found, start).cast("long"),
        )

    n, k, t = (c.cast("double") for c in (draws, good, total))
    mode = F.least(n, k, F.greatest(n + k - t, F.lit(0.0), F.floor((n + 1) * (k + 1) / (t + 2))))
    return F.when((draws <= 0) | (good <= 0), F.lit(0).cast("long")).when(good >= total, draws.cast("long")).otherwise(
        let(F.struct(n.alias("n"), k.alias("k"), t.alias("t"), mode.alias("mode"), u.alias("u")), draw)
    )


def _deal(sizes: Column, capacity: Column, shards: int, seed: int, level: int) -> Column:
    """Matrix rows for `sizes` (array of struct id, n) whose columns add up to `capacity`.

    Returns an array of struct(id, dealt array); earlier rows take from what later ones may.
    """

    def one(left: Column, size: Column) -> Column:
        first = F.struct(
            size.n.alias("draws"), F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
            F.array().cast("array<bigint>").alias("dealt"),
        )

        def shard(a, j):
            good = F.element_at(left, j + 1)
            return let(
                hypergeometric(a.draws, good, a.total, _uniform(F.lit(seed), F.lit(level), size.id, j)),
                lambda x: F.struct(
                    (a.draws - x).alias("draws"), (a.total - good).alias("total"),
                    F.concat(a.dealt, F.array(x)).alias("dealt"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), first, shard, lambda a: a.dealt)

    start = F.struct(capacity.alias("left"), F.array().cast("array<struct<id:bigint,dealt:array<bigint>>>").alias("rows"))
    return F.aggregate(
        sizes,
        start,
        lambda acc, size: let(
            one(acc.left, size),
            lambda dealt: F.struct(
                F.zip_with(acc.left, dealt, lambda a, b: a - b).alias("left"),
                F.concat(acc.rows, F.array(F.struct(size.id.alias("id"), dealt.alias("dealt")))).alias("rows"),
            ),
        ),
        lambda acc: acc.rows,
    )


def communication_matrix(sizes: DataFrame, shards: int, seed: int, fan: int) -> DataFrame:
    """(bucket, dealt) for `sizes` (bucket, n): rows of the matrix, shard sizes at most one apart.

    Drawn in two levels of about the square root of the number of buckets, so that no array
    holds all of them: first for groups of `fan` buckets, then for the buckets of each group.
    """
    sizes = sizes.withColumn("part", F.floor(F.col("bucket") / fan))
    parts = sizes.groupBy("part").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.col("bucket").alias("id"), "n"))).alias("sizes")
    )
    top = parts.agg(
        F.sort_array(F.collect_list(F.struct(F.col("part").alias("id"), "n"))).alias("sizes"), F.sum("n").alias("total")
    )
    base, rest = F.floor(F.col("total") / shards), F.col("total") % shards
    even = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: (base + (j < rest).cast("long")).cast("long"))
    shares = top.where("total > 0").select(F.explode(_deal(F.col("sizes"), even, shards, seed, 0)).alias("x")).select(
        F.col("x.id").alias("part"), F.col("x.dealt").alias("share")
    )
    return (
        parts.join(shares, "part")
        .select(F.explode(_deal(F.col("sizes"), F.col("share"), shards, seed, 1)).alias("x"))
        .select(F.col("x.id").alias("bucket"), F.col("x.dealt").alias("dealt"))
    )


def shuffle_shards(
    rows: DataFrame, shards: int = SHARDS, seed: int = 7, row_key: list[str] | None = None, size: int | None = None
) -> DataFrame:
    """`rows` with `shard` (0 to shards - 1, sizes at most one apart) and `slot` (gapless from 0 in a shard).

    Each row's place is uniform over all places. `size` is the number of rows, counted if not given.
    """
    key = row_key or hashable(rows)
    count = rows.count() if size is None else size
    bits = max(1, (max(shuffle_partitions(rows.sparkSession), -(-count // ROWS_PER_BUCKET)) - 1).bit_length())
    keys = [F.col(f"row.`{c}`") for c in key]
    hashed = packed(rows, "row").select(
        "row",
        F.xxhash64(F.lit(seed), *keys).alias("first"),
        F.xxhash64(F.lit(seed + 1), F.lit("again"), *keys).alias("second"),
    )
    placed = hashed.withColumn("bucket", F.shiftrightunsigned("first", 64 - bits))
    matrix = communication_matrix(
        placed.groupBy("bucket").agg(F.count("*").alias("n")), shards, seed, 1 << (bits + 1) // 2
    )
    in_bucket = Window.partitionBy("bucket").orderBy("first", "second")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda j: F.aggregate(F.slice("dealt", 1, j), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    sent = (
        placed.withColumn("rank", F.row_number().over(in_bucket))
        .join(matrix.withColumn("ends", ends).drop("dealt"), "bucket")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))))
        .withColumn("block", F.shiftrightunsigned("second", 64 - max(1, bits - 3)))
        .select("row", "first", "second", "shard", "block")
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sent.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    in_block = Window.partitionBy("shard", "block").orderBy("second", "first")
    done = sent.withColumn("rank", F.row_number().over(in_block)).join(offsets, ["shard", "block"])
    return unpacked(
        done, "row", {"shard": F.col("shard").cast("int"), "slot": (F.col("offset") + F.col("rank") - 1).cast("long")}
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("line")
    )
    sharded = shuffle_shards(docs, SHARDS, row_key=["file", "line", "doc_id"])
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
