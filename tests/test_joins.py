"""Joins with heavy keys against a nested loop."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapmart.operators import joins
from snapmart.operators.joins import KeyGrid, find_heavy_keys, repeated_keys, rows_with_repeated_key

KEYS = ("k", "d")


def frame(spark, rows, value):
    return spark.createDataFrame(rows, f"k string, d int, {value} int").repartition(3)


def brute_force(left, right, how):
    out = Counter()
    for lk, ld, lv in left:
        hits = [rv for rk, rd, rv in right if lk is not None and ld is not None and (rk, rd) == (lk, ld)]
        if not hits and how == "left":
            hits = [None]
        for rv in hits:
            out[lk, ld, lv, rv] += 1
    return out


def make_rows(seed, n, hot):
    """A third of the rows on one key, many without a key, whole groups of equal rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if hot and i % 3 == 0:
            rows.append((*hot, i % 5))
        elif i % 11 == 0:
            rows.append((None, 1, i))
        else:
            rows.append((f"c{rng.randrange(n // 4)}", rng.randrange(2), i))
    return rows


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(
    "hot_left,hot_right", [(("h", 1), ("g", 0)), (("h", 1), ("h", 1)), (("h", 1), None), (None, ("g", 0))]
)
def test_grid_join_equals_nested_loop(spark, how, hot_left, hot_right):
    left_rows, right_rows = make_rows(1, 240, hot_left), make_rows(2, 150, hot_right)
    left_rows += [("g", 0, 1), ("g", 0, 2), ("only left", 0, 1)]
    left, right = frame(spark, left_rows, "l"), frame(spark, right_rows, "r")
    heavy = find_heavy_keys([left, right], KEYS, rows_per_cell=9)
    assert {hot_left, hot_right} - {None} <= {(r.k, r.d) for r in heavy.sizes.collect()}
    grid = KeyGrid(heavy)
    joined = grid.join(grid.left(left), grid.right(right), how)
    unique = left.select(*KEYS).union(right.select(*KEYS)).distinct().withColumn("u", F.length("k"))
    both = grid.done(joined.join(grid.every(unique), grid.on, "left"))
    assert both.columns == ["k", "d", "l", "r", "u"]
    rows = both.collect()
    assert Counter((r.k, r.d, r.l, r.r) for r in rows) == brute_force(left_rows, right_rows, how)
    assert all(r.u == (None if r.k is None else len(r.k)) for r in rows)


def test_heavy_rows_spread_over_cells(spark):
    left = frame(spark, [("h", 1, 7)] * 300, "l")
    grid = KeyGrid(find_heavy_keys([left, left], KEYS, rows_per_cell=30))
    # Ten left cells of about thirty rows, each copied to ten right cells.
    sizes = [r["count"] for r in grid.left(left).groupBy("cell_left").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 3000 and max(sizes) < 400
    per_cell = grid.left(left).groupBy("cell_left", "cell_right").count().agg(F.max("count")).first()[0]
    assert per_cell < 60


def test_cells_are_found_by_hash(spark):
    left = frame(spark, [("h", 1, 7)] * 30, "l")
    grid = KeyGrid(find_heavy_keys([left, left], KEYS, rows_per_cell=10))
    text = grid.left(left)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text


def test_no_heavy_key_leaves_the_plain_join(spark):
    left = frame(spark, make_rows(1, 60, ("h", 1)), "l")
    heavy = find_heavy_keys([left], KEYS)
    assert not heavy and KeyGrid(heavy).left(left) is left


def test_counts_are_exact(spark):
    left, right = frame(spark, [("h", 1, 0)] * 40, "l"), frame(spark, [("h", 1, 0)] * 3, "r")
    rows = find_heavy_keys([left, right], KEYS, rows_per_cell=10).sizes.collect()
    assert [(r.k, r.d, r.n0, r.n1, r.n_left, r.n_right) for r in rows] == [("h", 1, 40, 3, 4, 1)]


def test_no_heavy_key_is_missed(spark):
    """Many keys just above the limit among many rows: no share of the table decides."""
    rows = [(f"k{i}", 0, j) for i in range(60) for j in range(12)] + [(f"light{i}", 0, i) for i in range(3000)]
    heavy = find_heavy_keys([frame(spark, rows, "l")], KEYS, rows_per_cell=11)
    assert {r.k for r in heavy.sizes.collect()} == {f"k{i}" for i in range(60)}


def test_two_sides_just_under_the_limit(spark, monkeypatch):
    """Neither side is heavy by rows, but their pairs are: the largest cell stays bounded."""
    monkeypatch.setattr(joins, "PAIRS_PER_ROW", 10)
    left, right = frame(spark, [("h", 1, i) for i in range(90)], "l"), frame(spark, [("h", 1, i) for i in range(90)], "r")
    grid = KeyGrid(find_heavy_keys([left, right], KEYS, rows_per_cell=100))
    assert grid.active
    joined = grid.join(grid.left(left), grid.right(right), "inner")
    cells = joined.groupBy(*[c for c in joined.columns if c.startswith("cell_")]).count().collect()
    assert sum(c["count"] for c in cells) == 8100 and max(c["count"] for c in cells) <= 2200
    got = joins.balanced_join(left, right, KEYS, "inner", rows_per_cell=100)
    assert got.columns == ["k", "d", "l", "r"] and got.distinct().count() == got.count() == 8100


def test_copies_stay_a_multiple_of_the_input(spark, monkeypatch):
    """Two keys of 600 rows a side in cells of 4 asked for: cells widen, and no pair is lost."""
    monkeypatch.setattr(joins, "FEW_COPIES", 0)
    rows = [("h", i % 2, i) for i in range(1200)] + [(None, 1, i) for i in range(90)] + [(f"c{i}", 0, i) for i in range(300)]
    left, right = frame(spark, rows, "l"), frame(spark, rows, "r")
    grid = KeyGrid(find_heavy_keys([left, right], KEYS, rows_per_cell=4))
    placed = grid.left(left).count() + grid.right(right).count()
    assert grid.deals_left and placed <= (1 + joins.COPIES) * 2 * len(rows)
    got = joins.balanced_join(left, right, KEYS, "inner", rows_per_cell=4)
    assert got.distinct().count() == got.count() == 2 * 600**2 + 300
    assert joins.balanced_join(left, right, KEYS, "left", rows_per_cell=4).count() == 2 * 600**2 + 300 + 90


def test_widened_cells_keep_the_bound_of_rows(spark, monkeypatch):
    """Cells widen up to the most rows that a task should take of a side, whatever the copies."""
    monkeypatch.setattr(joins, "FEW_COPIES", 0)
    monkeypatch.setattr(joins, "ROWS_PER_CELL", 50)
    left, right = frame(spark, [("h", 1, i) for i in range(600)], "l"), frame(spark, [("h", 1, i) for i in range(600)], "r")
    (key,) = find_heavy_keys([left, right], KEYS, rows_per_cell=4).sizes.collect()
    assert (key.n_left, key.n_right) == (12, 12)


def test_tasks_make_like_numbers_of_pairs(spark, monkeypatch):
    """Three hot keys of 400 rows in grids of 4 x 4: no task makes more than its cells' share, whatever their bytes."""
    monkeypatch.setattr(joins, "FEW_COPIES", 0)
    rows = [(f"h{i % 3}", 1, i) for i in range(1200)] + [(f"c{i}", 0, i) for i in range(60)]
    left, right = frame(spark, rows, "l"), frame(spark, rows, "r")
    got = joins.balanced_join(left, right, KEYS, "inner", rows_per_cell=100)
    per_task = {r.t: r["count"] for r in got.groupBy(F.spark_partition_id().alias("t")).count().collect()}
    pairs = 3 * 400**2 + 60
    assert sum(per_task.values()) == pairs and len(per_task) == 8 and max(per_task.values()) < 1.5 * pairs / 8


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_of_two_types_meet(spark, how):
    """An int key and an equal long key go to one task, heavy or light."""
    rows = [(i % 7 if i % 2 else 100, i) for i in range(300)] + [(None, 1), (8, 2)]
    left = spark.createDataFrame(rows, "k int, l int").repartition(3)
    right = spark.createDataFrame([r for r in rows if r[0] != 3], "k bigint, r int").repartition(3)
    got = Counter((r.k, r.l, r.r) for r in joins.balanced_join(left, right, ("k",), how, rows_per_cell=30).collect())
    want = Counter()
    for k, v in rows:
        hits = [w for q, w in rows if k is not None and q == k and k != 3]
        want.update((k, v, w) for w in hits or ([None] if how == "left" else []))
    assert got == want


@pytest.mark.parametrize("how", ["left", "inner"])
def test_balanced_join_equals_nested_loop(spark, how):
    """Null keys, hot keys on one side or both, and groups of equal rows, dealt out to more tasks than cells."""
    left_rows, right_rows = make_rows(1, 240, ("h", 1)), make_rows(2, 150, ("h", 1)) + [("g", 0, i) for i in range(40)]
    left_rows += [("g", 0, 1), ("g", 0, 2), ("only left", 0, 1)]
    got = joins.balanced_join(frame(spark, left_rows, "l"), frame(spark, right_rows, "r"), KEYS, how, rows_per_cell=9)
    assert got.columns == ["k", "d", "l", "r"]
    assert Counter(map(tuple, got.collect())) == brute_force(left_rows, right_rows, how)


@pytest.mark.parametrize("rows_per_cell", [5, joins.ROWS_PER_CELL])
def test_repeated_key_rows(spark, rows_per_cell):
    rows = make_rows(3, 200, ("h", 1))
    df = frame(spark, rows, "v")
    count = Counter(r[0] for r in rows if r[0] is not None)
    want = Counter(r for r in rows if count[r[0]] > 1)
    got = rows_with_repeated_key(df, "k", rows_per_cell=rows_per_cell).collect()
    assert Counter((r.k, r.d, r.v) for r in got) == want


def test_repeated_keys_are_unique(spark):
    df = frame(spark, [("a", 1, 1), ("a", 1, 2), ("b", 1, 1)], "v")
    assert [r.k for r in repeated_keys(df, "k").collect()] == ["a"]
