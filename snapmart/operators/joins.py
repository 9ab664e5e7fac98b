"""Equi-joins that stay balanced when a few keys hold a large share of the rows.

A plain shuffle join sends all rows of a key to one task, and that task makes all pairs
of the key. Keys are heavy if either side has more rows of them than a cell may hold, or
if both sides together make more pairs than that. They are found exactly: rows are counted
by hash bucket (partial counts before the shuffle), and only in buckets that could hold a
heavy key are keys counted. Without any, the join is the ordinary one. Otherwise each heavy
key gets a grid of cells: left rows are dealt over its rows of the grid and copied along
the columns, right rows the other way round, and the join runs on key and cell. Every pair
of matching rows meets in exactly one cell, so the result is complete for any sizes.

Small cells cost copies: a key of n rows a side is copied n / rows of a cell times. Where the copies
of all grids would pass a multiple of the input, cells are widened together until they
do not, up to ROWS_PER_CELL rows of a side. Wider cells change where pairs meet, not which.

A cell has few bytes and many pairs, so neither hashing nor merging partitions by their size gives
tasks like amounts of work. ``balanced_join`` deals cells out to tasks in turn, and Spark leaves them there.

Rows are dealt by their position in the scan, which a recomputed task reproduces.
Inputs should therefore come straight from a table or a checkpoint, not from
behind a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.workdir import scratch_path

# Rows of a key on one side, and pairs of a key, that one cell should take.
ROWS_PER_CELL = 1_000_000
PAIRS_PER_ROW = 100
# Rows that copies may add: so many for each row of the frames, and a number that is small for any table.
COPIES, FEW_COPIES = 1, 1_000_000
# Cells are widened in steps, left and right in turn, so many steps to a doubling and so many doublings at most.
STEPS, DOUBLINGS = 4, 24
# Hash buckets of the first look at the keys.
FIRST_BUCKETS = 4_096

# Pairs that are worth a task of their own.
PAIRS_PER_TASK = 250_000_000
# Keys with more than this share of all cells follow one another over the tasks; others start anywhere.
ONE_IN = 1_000

CELL = ("cell_left", "cell_right")
TASK = "cell_task"


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy keys with their rows in each frame (n0, n1) and the grid of each, as a written table.

    With ``tasks``, the table also has the task that each key's first cell goes to.
    """

    keys: tuple[str, ...]
    sizes: DataFrame | None = None
    deals_left: bool = False
    deals_right: bool = False
    cells: int = 0
    pairs: float = 0.0
    tasks: int | None = None

    def __bool__(self) -> bool:
        return self.sizes is not None


def largest_buckets(df: DataFrame, keys: tuple[str, ...], by: str) -> DataFrame:
    """Rows of the largest hash bucket of the keys, for each value of ``by``: a bound for the rows of a key."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(FIRST_BUCKETS)).alias("bucket")
    return df.groupBy(by, bucket).agg(F.count("*").alias("n")).groupBy(by).agg(F.max("n").alias("largest"))


def surely_light(largest: list[int], *, rows_per_cell: int = ROWS_PER_CELL) -> bool:
    """True if keys with at most so many rows in each frame cannot be heavy."""
    pairs = math.prod(largest) if len(largest) == 2 else 0
    return max(largest, default=0) <= rows_per_cell and pairs <= rows_per_cell * PAIRS_PER_ROW


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def find_heavy_keys(
    frames: list[DataFrame], keys: tuple[str, ...], *, rows_per_cell: int = ROWS_PER_CELL
) -> HeavyKeys:
    """Keys with more rows, or more pairs between two frames, than one task should take.

    Row totals and the largest grid come to the driver, no keys do.
    """
    pairs = rows_per_cell * PAIRS_PER_ROW
    names = [f"n{i}" for i in range(len(frames))]
    tagged = _stack([f.select(*keys, F.lit(i).alias("frame")) for i, f in enumerate(frames)])
    counts = [F.count_if(F.col("frame") == i).alias(n) for i, n in enumerate(names)]

    def heavy(row: dict) -> Column:
        """Also true for no rows of one side: nulls and left rows without a match are dealt too."""
        many = reduce(lambda a, b: a | b, [row[n] > rows_per_cell for n in names])
        return many | (row["n0"].cast("double") * row["n1"] > pairs) if len(frames) == 2 else many

    def in_buckets(n: int) -> tuple[DataFrame, DataFrame]:
        placed = tagged.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(n)))
        return placed, placed.groupBy("bucket").agg(*counts)

    # One job settles most inputs: no key has more rows or pairs than its bucket.
    _, counted = in_buckets(FIRST_BUCKETS)
    first = counted.agg(
        F.count_if(heavy({n: F.col(n) for n in names})).alias("heavy"), *[F.sum(n).alias(n) for n in names]
    ).first()
    if not first.heavy:
        return HeavyKeys(tuple(keys))
    # So many that a bucket of ordinary keys is far below both limits.
    fair = min(rows_per_cell, math.isqrt(pairs)) if len(frames) == 2 else rows_per_cell
    rows = sum(first[n] for n in names)
    placed, counted = in_buckets(max(FIRST_BUCKETS, 1 << (8 * rows // fair + 1).bit_length()))
    full = counted.filter(heavy({n: F.col(n) for n in names})).select("bucket")
    exact = placed.join(full, "bucket", "left_semi").groupBy(*keys).agg(*counts)
    found = exact.filter(heavy({n: F.col(n) for n in names}))
    if len(frames) == 1:
        found = found.withColumn("n1", F.lit(0).cast("bigint"))
    path = scratch_path(tagged.sparkSession, "heavy-keys")
    found.write.parquet(path)
    found = tagged.sparkSession.read.schema(found.schema).parquet(path)
    # A null key matches nothing: its left rows are dealt, never copied.
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows_left, rows_right = F.col("n0"), F.when(null, 0).otherwise(F.col("n1"))

    def cells(step: Column) -> tuple[Column, Column]:
        """Left and right cells of a key, after so many steps of widening."""
        wide = [F.pow(F.lit(2.0), F.floor((step + i) / 2) / STEPS) for i in (1, 0)]
        most = [F.greatest(F.lit(rows_per_cell), F.least(w * rows_per_cell, F.lit(ROWS_PER_CELL))) for w in wide]
        left, right = F.greatest(rows_left / most[0], F.lit(1)), F.greatest(rows_right / most[1], F.lit(1))
        made = rows_left.cast("double") * rows_right / (left * right)
        side = F.greatest(F.sqrt(made / (wide[0] * wide[1] * float(pairs))), F.lit(1))
        return F.ceil(left * side), F.ceil(right * side)

    steps = range(2 * STEPS * DOUBLINGS + 1)
    left, right = cells(F.col("step"))
    copies = rows_left.cast("double") * (right - 1) + rows_right.cast("double") * (left - 1)
    tried = found.withColumn("step", F.explode(F.lit(list(steps))))
    added = {r.step: r.added for r in tried.groupBy("step").agg(F.sum(copies).alias("added")).collect()}
    allowed = max(COPIES * rows, FEW_COPIES)
    step = next((s for s in steps if (added.get(s) or 0) <= allowed), steps[-1])
    n_left, n_right = cells(F.lit(step))
    sizes = found.select(*keys, "n0", "n1", n_left.alias("n_left"), n_right.alias("n_right"))
    grid = sizes.agg(
        F.count("*").alias("n"), F.max("n_left").alias("left"), F.max("n_right").alias("right"),
        F.sum(F.col("n_left") * F.col("n_right")).alias("cells"),
        F.sum(rows_left.cast("double") * rows_right).alias("pairs"),
    ).first()
    if not grid.n:
        return HeavyKeys(tuple(keys))
    return HeavyKeys(tuple(keys), sizes, grid.left > 1, grid.right > 1, grid.cells, grid.pairs)


def dealt_to_tasks(heavy: HeavyKeys) -> HeavyKeys:
    """The heavy keys with a first task for each, so that tasks get like numbers of cells.

    Keys with a large share of the cells, which are few, are laid one after the other, largest
    cells first; so a task has at most one cell of them more than another.
    """
    if not (heavy.deals_left or heavy.deals_right):
        return heavy
    spark = heavy.sizes.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), min(heavy.cells, math.ceil(heavy.pairs / PAIRS_PER_TASK))
    )
    cells = F.col("n_left") * F.col("n_right")
    large = cells * ONE_IN > heavy.cells
    before = Window.orderBy(F.desc(F.col("n0").cast("double") * F.col("n1") / cells), *heavy.keys)
    laid = heavy.sizes.filter(large).withColumn("_start", F.sum(cells).over(before.rowsBetween(Window.unboundedPreceding, 0)) - cells)
    path = scratch_path(spark, "heavy-tasks")
    rest = heavy.sizes.filter(~large).withColumn("_start", F.pmod(F.xxhash64(*heavy.keys), F.lit(tasks)))
    laid.unionByName(rest).write.parquet(path)
    return replace(heavy, sizes=spark.read.schema(laid.schema).parquet(path), tasks=tasks)


class KeyGrid:
    """Cells for the heavy keys of a left and a right frame.

    Only the directions some key needs become columns: with no heavy key on the right
    there are no right cells, and without heavy keys there is no grid at all.
    """

    def __init__(self, heavy: HeavyKeys):
        self.keys = list(heavy.keys)
        self.deals_left, self.deals_right = heavy.deals_left, heavy.deals_right
        used = (self.deals_left, self.deals_right)
        self.on = self.keys + [cell for cell, needed in zip(CELL, used) if needed]
        self._sizes = heavy.sizes.drop("n0", "n1") if heavy else None
        self._tasks = heavy.tasks
        if self._tasks:
            self.on.append(TASK)

    @property
    def active(self) -> bool:
        return self.deals_left or self.deals_right

    def _place(self, df: DataFrame, left_cell: Column, right_cell: Column) -> DataFrame:
        """Add the cells of each row, from the grid size of its key.

        Spark broadcasts the sizes where they are small, and splits skewed rows otherwise.
        """
        sizes = self._sizes.withColumnsRenamed({k: f"_{k}" for k in self.keys})
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(sizes[f"_{k}"]) for k in self.keys])
        placed = (
            df.withColumn("_at", F.monotonically_increasing_id())
            .join(sizes, same, "left")
            .fillna(1, ["n_left", "n_right"])
        )
        if self.deals_left:
            placed = placed.withColumn(CELL[0], left_cell)
        if self.deals_right:
            placed = placed.withColumn(CELL[1], right_cell)
        if self._tasks:
            placed = self._to_tasks(placed)
        return placed.drop("_at", "n_left", *[f"_{k}" for k in self.keys])

    def _to_tasks(self, placed: DataFrame) -> DataFrame:
        """Each cell of a heavy key goes to the task after that of the cell before; light keys go by their hash."""
        # As both frames' keys compare: equal keys of other types have one hash.
        types = {f.name: f.dataType for f in self._sizes.schema}
        by_hash = F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in self.keys]), F.lit(self._tasks))
        left, right = (F.col(c) if c in placed.columns else F.lit(0) for c in CELL)
        task = F.coalesce("_start", by_hash) + left * F.col("n_right") + right
        placed = placed.withColumn(TASK, F.pmod(task, F.lit(self._tasks)).cast("int"))
        return placed.drop("_start").repartitionById(self._tasks, TASK)

    @staticmethod
    def _dealt(size: str) -> Column:
        return F.pmod(F.col("_at"), F.col(size))

    @staticmethod
    def _copied(size: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(size) - 1))

    def left(self, df: DataFrame) -> DataFrame:
        """Deal rows over the left cells, copy them along the right cells."""
        return self._place(df, self._dealt("n_left"), self._copied("n_right")) if self.active else df

    def right(self, df: DataFrame) -> DataFrame:
        """Copy rows along the left cells, deal them over the right cells."""
        if not self.active:
            return df
        known = df.dropna(subset=self.keys)
        return self._place(known, self._copied("n_left"), self._dealt("n_right")).drop("n_right")

    def every(self, df: DataFrame) -> DataFrame:
        """Copy rows into every cell: for frames with one row per key."""
        if not self.active:
            return df
        return self._place(df, self._copied("n_left"), self._copied("n_right")).drop("n_right")

    def join(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Join two frames placed on the grid; ``how`` is inner or left."""
        if how == "inner" or not self.deals_right:
            return (left.drop("n_right") if self.active else left).join(right, self.on, how)
        joined = left.join(right.withColumn("_hit", F.lit(True)), self.on, how)
        # With several right cells the key is known to be on the right, so the left
        # row has its match in some cell; its copies in the others are not results.
        return joined.filter(F.col("_hit") | (F.col("n_right") == 1)).drop("_hit", "n_right")

    def done(self, df: DataFrame) -> DataFrame:
        """Drop the cells."""
        return df.drop(*CELL, *([TASK] if self._tasks else [])) if self.active else df


def balanced_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str, *, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Inner or left join on ``keys`` whose heavy keys are dealt over cells."""
    grid = KeyGrid(dealt_to_tasks(find_heavy_keys([left, right], keys, rows_per_cell=rows_per_cell)))
    return grid.done(grid.join(grid.left(left), grid.right(right), how))


def rows_with_repeated_key(
    df: DataFrame, key: str, *, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Rows whose key occurs more than once; rows without a key are left out.

    A heavy key is known to repeat, so its rows only meet the table of heavy keys;
    the rest goes through a semi-join with the repeated keys.
    """
    known = df.filter(F.col(key).isNotNull())
    heavy = find_heavy_keys([known], (key,), rows_per_cell=rows_per_cell)
    if not heavy:
        return known.join(repeated_keys(known, key), key, "left_semi")
    sure = heavy.sizes.filter("n0 > 1").select(key)
    rest = known.join(sure, key, "left_anti")
    return known.join(sure, key, "left_semi").unionByName(
        rest.join(repeated_keys(rest, key), key, "left_semi")
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(key)
