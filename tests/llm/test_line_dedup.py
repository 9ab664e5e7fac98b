import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm.line_dedup import LOWER, SQL, UPPER, WHITE, PerfectHash, Shard, blocks_of, drop_shared_lines, op12_line_dedup, shared_lines
from tests.check_oracle import compare, connect
from tests.llm.conftest import EDGE, SF, rows


def key(line):
    return line.strip(WHITE).translate(str.maketrans(UPPER, LOWER))


def brute(docs, least_documents=10, least_chars=1):
    lines = [(text or "").split("\n") for _, text, *_ in docs]
    held = Counter(k for own in lines for k in {key(x) for x in own} if len(k) >= least_chars)
    out = []
    for (doc_id, *_), own in zip(docs, lines):
        kept = [x for x in own if held[key(x)] < least_documents]
        out.append((doc_id, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 20_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    index = PerfectHash(keys)
    assert sorted(index.find(keys).tolist()) == list(range(len(keys))) and len(index) == len(keys)
    others = index.find(rng.integers(1 << 63, (1 << 64) - 1, 1000, dtype=np.uint64))
    assert ((others >= -1) & (others < max(len(keys), 1))).all()
    if n > 1000:
        assert 8 * index.nbytes / n < 8


def test_keys_without_a_place_are_listed(monkeypatch):
    monkeypatch.setattr("snapmart.llm.line_dedup._LEVELS", 1)
    keys = np.arange(5000, dtype=np.uint64)
    index = PerfectHash(keys)
    assert len(index.rest) > 500 and sorted(index.find(keys).tolist()) == list(range(5000))


def test_shard_knows_its_hashes_only():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, (2, 5000), dtype=np.uint64)
    a[100:110] = a[0]  # equal first halves
    n = np.arange(10, 5010)
    shard = Shard(a[:4000], b[:4000], n[:4000])
    assert shard.probe(a[:4000], b[:4000]).tolist() == n[:4000].tolist()
    assert not shard.probe(a[4000:], b[4000:]).any() and not shard.probe(a[:4000], b[:4000] ^ np.uint64(1)).any()


def corpus():
    rng = random.Random(5)
    common = ["Share this page", "  SHARE this PAGE\t", "é Ünïcode LINE", "", "   ", "x", "All rights reserved"]
    docs = []
    for k in range(300):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"own line {rng.randrange(400)}" for _ in range(rng.randrange(1, 30))]
        docs.append((k, "\n".join(lines)))
    return docs + [(500, "Share this page"), (501, "Share this page\n"), (502, "\n"), (503, None), (503, "Share this page\r\nand more\v")]


@pytest.mark.parametrize("sizes", [{}, {"shard_keys": 5, "block_bytes": 100}])
def test_rows(spark, sizes):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert rows(drop_shared_lines(df, **sizes)) == brute(docs)
    assert rows(drop_shared_lines(df, least_documents=3, least_chars=4, **sizes)) == brute(docs, 3, 4)


def test_several_blocks_are_sent_one_at_a_time(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    shared = shared_lines(df, least_documents=2)
    held = {(r.a, r.b): r.n for r in shared.collect()}
    found, sent = Counter(), 0
    a, b = (np.array([k[i] for k in held], np.int64).view(np.uint64) for i in (0, 1))
    for block, last in blocks_of(shared, shard_keys=20, block_bytes=1000):
        sent += 1
        for k, n in zip(held, block.value.probe(a, b).tolist()):
            found[k] += n
    assert last and sent > 3 and dict(found) == held


def test_edge_rows(edge, clashing, empty):
    for docs in (edge, clashing, edge.repartition(5)):
        assert rows(drop_shared_lines(docs, least_documents=2)) == brute(EDGE, 2)
    assert drop_shared_lines(empty).count() == 0


def test_hot_line_is_counted_before_the_shuffle(spark):
    docs = spark.range(0, 3000, 1, 6).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot line\nline "), "id").alias("text"))
    plan = shared_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Python" not in plan
    assert {r.n_dropped for r in drop_shared_lines(docs).collect()} == {1}


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), SF, "op12", op12_line_dedup, SQL) is None
