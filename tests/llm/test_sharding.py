import collections
import math
import zlib

import pytest
from pyspark.sql import functions as F

from snapmart.llm.sharding import _uniform, communication_matrix, hypergeometric, op1_sharding, shuffle_shards
from tests.llm.conftest import SF


@pytest.mark.parametrize("n,k,t", [(10, 5, 20), (40, 300, 500), (5, 5, 5), (0, 3, 5), (3, 2, 4), (7, 1, 9)])
def test_hypergeometric_has_its_distribution(spark, n, k, t):
    draws = 20_000
    got = collections.Counter(
        r.x
        for r in spark.range(draws)
        .select(hypergeometric(F.lit(n), F.lit(k), F.lit(t), _uniform(F.lit(3), F.col("id"))).alias("x"))
        .collect()
    )
    for x in range(max(0, n + k - t), min(n, k) + 1):
        p = math.comb(k, x) * math.comb(t - k, n - x) / math.comb(t, n)
        assert abs(got[x] / draws - p) < 5 * math.sqrt(p * (1 - p) / draws) + 1e-3
    assert set(got) <= set(range(max(0, n + k - t), min(n, k) + 1))


def test_matrix_has_the_given_row_and_column_sums(spark):
    sizes = [(b, (b * 7) % 23) for b in range(40)]
    got = communication_matrix(spark.createDataFrame(sizes, "bucket bigint, n bigint"), 5, 1, 8).collect()
    assert {r.bucket: sum(r.dealt) for r in got} == dict(sizes)
    columns = [sum(r.dealt[j] for r in got) for j in range(5)]
    assert sum(columns) == sum(n for _, n in sizes) and max(columns) - min(columns) <= 1
    assert all(x >= 0 for r in got for x in r.dealt)


def check(df, n, shards):
    by = collections.defaultdict(list)
    for r in df.select("shard", "slot").collect():
        by[r.shard].append(r.slot)
    assert sum(map(len, by.values())) == n and set(by) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_edge_rows(edge, clashing, empty):
    check(shuffle_shards(edge, 3), 11, 3)
    out = shuffle_shards(clashing, 4)
    check(out, 11, 4)
    assert set(out.columns) == set(clashing.columns) and dict(out.dtypes)["slot"] == "bigint"
    assert shuffle_shards(empty, 4).count() == 0


def test_more_shards_than_rows(spark):
    check(shuffle_shards(spark.range(3), 8), 3, 8)


def test_one_key_for_all_rows(spark):
    check(shuffle_shards(spark.range(500).select(F.lit(1).alias("x")), 7), 500, 7)


def test_seed_decides(spark):
    rows = spark.range(2000)
    one = {r.id: (r.shard, r.slot) for r in shuffle_shards(rows, 4, seed=1).collect()}
    assert one == {r.id: (r.shard, r.slot) for r in shuffle_shards(rows.repartition(5), 4, seed=1).collect()}
    other = {r.id: (r.shard, r.slot) for r in shuffle_shards(rows, 4, seed=2).collect()}
    assert sum(one[k] == other[k] for k in one) < 20


def test_places_are_uniform(spark):
    """Neighbouring ids part, and each shard gets its share of low ids."""
    got = shuffle_shards(spark.range(8000), 4, seed=5).collect()
    low = collections.Counter(r.shard for r in got if r.id < 4000)
    assert all(abs(low[s] - 1000) < 120 for s in range(4))
    early = sum(r.slot < 1000 for r in got if r.id < 4000)
    assert abs(early - 2000) < 150


def test_query(spark):
    got = op1_sharding(spark, SF)
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = got.collect()
    check(got, len(docs), 8)
    assert {r.doc_id for r in found} == set(docs)
    for r in found:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 1, zlib.crc32(docs[r.doc_id]), "rows", None)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
