import collections
import random
import re

import numpy as np
import pytest
import xxhash

from snapmart.llm.components import components
from snapmart.llm.simhash import DENSE_KEY, fingerprint, first_of_each_class, links, near_duplicate_classes, near_duplicates, op5_simhash
from tests.llm.conftest import EDGE, LONG, SF, rows


def slow_print(text, size=4):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    """Smallest member index of each one's class."""
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [find(a) for a in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " ", "a", "A b C", "a b c d", "É A a É x  y\tz\x1f q", "same " * 9, LONG[:2000] + "é日𝒳"])
def test_fingerprint(text):
    assert fingerprint(text) == slow_print(text)


def test_long_text_in_pieces(monkeypatch):
    from snapmart.llm import simhash

    text = " ".join(str(k % 97) for k in range(3000))
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 100)
    assert fingerprint(text) == whole == slow_print(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clusters(rng, n, bits):
    """Centres, chains of near fingerprints, and strangers."""
    out = set()
    while len(out) < n:
        now = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.add(now)
            for b in rng.sample(range(64), rng.randint(1, bits + 2)):
                now ^= 1 << b
    return list(out)


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
@pytest.mark.parametrize("dense", [2, 1000])
def test_classes_match_all_pairs(spark, bits, dense):
    prints = clusters(random.Random(bits * 10 + 1), 300, bits)
    df = spark.createDataFrame([(signed(p), 1) for p in prints], "fp bigint, n bigint")
    got = {r.node: r.label for r in components(links(df, bits, dense), "test").collect()}
    want = classes(prints, bits)
    same = collections.defaultdict(set)
    for p, w in zip(prints, want):
        same[w].add(got.get(signed(p), signed(p)))
    assert all(len(labels) == 1 for labels in same.values())
    assert len({next(iter(x)) for x in same.values()}) == len(same)


def near_copies(rng, n):
    """A centre with many copies, and n - 1 others that differ from it in up to three bits."""
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < n:
        p = centre
        for b in rng.sample(range(64), rng.randint(1, 3)):
            p ^= 1 << b
        prints.add(p)
    return [(signed(p), 1000 if p == centre else 1) for p in prints]


def test_dense_group_gives_edges_in_proportion(spark):
    """Near copies of one text: a probe makes fewer pairs than a dense key holds, or one edge to its centre."""
    n = 3200
    df = spark.createDataFrame(near_copies(random.Random(4), n), "fp bigint, n bigint")
    probes = 5 + 64 / 2
    assert links(df).distinct().count() < n * probes * DENSE_KEY < n * n / 10
    got = near_duplicate_classes(df)
    assert got.select("label").distinct().count() == 1 and got.count() == n


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000)]
    got = {r.node: r.label for r in components(spark.createDataFrame(path, "a bigint, b bigint"), "test").collect()}
    assert got == {**{k: 0 for k in range(201)}, **{k: 1000 for k in range(1000, 1300)}}


def test_edge_rows(edge, clashing, empty):
    prints = [slow_print(t) for _, t, *_ in EDGE]
    want = classes(prints, 4)
    ids = collections.defaultdict(list)
    for (i, *_), c in zip(EDGE, want):
        ids[c].append(i)
    expect = sorted(
        ((i, f"{p:016x}", min([x for x in ids[c] if x is not None], default=None)) for (i, *_), p, c in zip(EDGE, prints, want)), key=repr
    )
    assert rows(near_duplicates(edge)) == rows(near_duplicates(clashing)) == expect
    assert near_duplicates(empty).count() == 0
    kept = first_of_each_class(clashing)
    assert kept.dtypes == clashing.dtypes and kept.count() == len(ids)
    assert first_of_each_class(empty).count() == 0


def test_query(spark):
    got = op5_simhash(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(docs)
    order = sorted(docs)
    prints = [slow_print(docs[i]) for i in order]
    want = {i: order[c] for i, c in zip(order, classes(prints, 4))}
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {
        i: (p, want[i]) for i, p in zip(order, prints)
    }
    assert np.array(prints, np.uint64).dtype == np.uint64
