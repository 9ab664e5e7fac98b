import pytest
from pyspark.sql import functions as F

from snapmart.llm import common
from snapmart.llm.components import components


def test_hot_keys_stay_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_OF_KEY", 50)
    left = spark.range(0, 6000, 1, 12).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700).alias("k"), "id")
    right = left.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for how in ("inner", "left"):
        got = common.join_hot(left, right, "k", "n", left.count(), how)
        want = left.join(right.drop("n"), "k", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        hot = got.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count()
        assert max(r["count"] for r in hot.collect()) < 300  # of 2,000 rows
    one_sided = common.join_hot(left, right.where("top % 2 = 0"), "k", "n", left.count(), "left")
    assert one_sided.count() == 6000 and one_sided.where("top IS NULL").count() > 0


@pytest.mark.parametrize("edges_of_node", [1 << 20, 10])
def test_components_of_a_hot_node(spark, monkeypatch, edges_of_node):
    monkeypatch.setattr(common, "ROWS_OF_KEY", 20)
    monkeypatch.setattr("snapmart.llm.components.EDGES_OF_NODE", edges_of_node)
    star = [(7, k) for k in range(100, 1100)]
    path = [(k, k + 1) for k in range(5000, 5050)]
    edges = spark.createDataFrame([*star, *path, (5000, 1050), (1, 2), (3, 3)], "a bigint, b bigint").repartition(5)
    got = {r.node: r.label for r in components(edges, "hot").collect()}
    assert got == {n: 7 for n in [7, *range(100, 1100), *range(5000, 5051)]} | {1: 1, 2: 1}
