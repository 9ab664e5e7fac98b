import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm import toxicity
from tests.llm.conftest import EDGE, SF

BAD = "vileword nastyone grimterm".split()


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 6)))
    out = []
    for k in range(n):
        words = [word() for _ in range(40)]
        toxic, junk = k % 4 == 0, k % 3 == 0
        if toxic:
            words[rng.randint(0, 39)] = rng.choice(BAD) + ("s" if k % 8 == 0 else "")
        if junk:
            words.insert(rng.randint(0, 39), "###")
        out.append((k, " ".join(words), int(not junk), int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(800, 1)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i < 600], "doc_id bigint, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    rest = [r for r in rows if r[0] >= 600]
    assert all(got[i].toxic == bool(x) for i, _, _, x in rest)
    assert all((got[i].p_junk > 0.5) == (not q) for i, _, q, _ in rest)


def test_filter_drops_the_toxic_and_keeps_columns(tables):
    rows, docs, labels = tables
    wide = docs.withColumns({"row": F.lit("r"), "p": F.lit("p")})
    kept = toxicity.without_toxic(wide, labels)
    assert kept.columns == wide.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, _, x in rows if not x}


def test_later_models_use_out_of_fold_probabilities():
    """A first category whose only feature is the row itself is known in training and to no other row."""
    rng = np.random.default_rng(1)
    n = 200
    first = rng.integers(0, 2, n)
    rows = [([k] if first[k] else [], [float(first[k]), float(first[k])]) for k in range(n)]
    chain = toxicity.fit_chain(["a", "b"], [f"f{k}" for k in range(n)], rows)
    # In-sample probabilities would give the second model a large weight on the first one.
    assert abs(chain.earlier[1, 0]) < 3


def test_chain_of_three_uses_earlier_categories():
    rng = np.random.default_rng(2)
    n = 600
    a, b = rng.integers(0, 2, n), rng.integers(0, 2, n)
    rows = [([0] * int(a[k]) + [1] * int(b[k]), [float(a[k]), float(b[k]), float(a[k] ^ b[k])]) for k in range(n)]
    chain = toxicity.fit_chain(["a", "b", "c"], ["x", "y"], rows)
    p = chain.probabilities(np.array([chain.weights[[0]].sum(0), chain.weights[[1]].sum(0), np.zeros(3)]))
    assert (p[:, 0] > 0.5).tolist() == [True, False, False] and (p[:, 1] > 0.5).tolist() == [False, True, False]
    assert np.abs(chain.earlier[2, :2]).sum() > 0 and np.triu(chain.earlier).sum() == 0


def test_constant_and_unknown_categories():
    rows = [([0], [1.0, None]), ([], [1.0, None])]
    chain = toxicity.fit_chain(["all", "none"], ["x"], rows)
    p = chain.probabilities(np.zeros((1, 2)))
    assert p[0, 0] > 0.9 and p[0, 1] < 1e-9


def test_edge_rows(spark, edge, clashing, empty, tables):
    _, docs, labels = tables
    assert toxicity.toxicity(edge, labels).count() == len(EDGE)
    none = labels.where("false")
    got = toxicity.toxicity(clashing, none).collect()
    assert len(got) == len(EDGE) and not any(r.toxic for r in got)
    assert toxicity.toxicity(empty, labels).count() == 0
    odd = labels.unionByName(spark.createDataFrame([(None, None, 1), (1, None, None), (10**9, 1, 1)], labels.schema))
    assert toxicity.toxicity(docs, odd).count() == 800
    assert toxicity.without_toxic(clashing, none).dtypes == clashing.dtypes


def test_query(spark):
    got = toxicity.op2_toxicity(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.count() == n and got.columns == ["doc_id", "toxic", "p_junk", "p_toxic"]
