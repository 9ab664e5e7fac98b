import math
import random
from collections import Counter

import numpy as np
import pytest

from snapmart.llm import decontamination as d
from tests.llm.conftest import SF, rows


def make_index(texts):
    parts = [p for t in texts for p in d.parts_of(d.words_of(t))]
    held = Counter(w for p in parts for w in set(p))
    return d.Index(list(enumerate(texts)), held, len(parts), np.mean([len(p) for p in parts])), parts, held


def words(rng, n, vocabulary=60):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


def brute_scores(ix, parts, held, query):
    parts = sorted(parts, key=len)
    mean = sum(map(len, parts)) / len(parts)
    out = {}
    for k, part in enumerate(parts):
        counts = Counter(part)

        def impact(w):
            idf = math.log(1 + (len(parts) - held[w] + 0.5) / (held[w] + 0.5))
            return idf * counts[w] * (d.K1 + 1) / (counts[w] + d.K1 * (1 - d.B + d.B * len(part) / mean))

        total = sum(map(impact, counts))
        out[k] = sum(impact(w) for w in counts if w in query) / total
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("least", [0.2, 0.6, 1.0])
def test_search_matches_full_scores(seed, least):
    rng = random.Random(seed)
    ix, parts, held = make_index([words(rng, rng.randint(1, 90)) for _ in range(60)])
    for _ in range(30):
        query = set(words(rng, rng.randint(0, 60)).split())
        got = dict(ix.search([ix.term[w] for w in sorted(query) if w in ix.term], least))
        want = {k: s for k, s in brute_scores(ix, parts, held, query).items() if s >= least - 1e-9}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_question_and_answer():
    assert d.question_and_answer("One two. Three four?\nFive") == (["one", "two", "three", "four"], ["five"])
    assert d.question_and_answer("one two three") == (["one", "two"], ["three"])
    assert d.question_and_answer("...") == ([], [])


ITEM = "What is the tallest of all the quiet mountains in the old kingdom? It is the one called Grey Harrow by its people."


def test_both_halves_must_overlap(spark):
    rng = random.Random(3)
    fill = words(rng, 300, 500)
    question, answer = ITEM.split("? ")
    texts = {
        1: fill + " " + ITEM + " " + fill, 2: fill + " " + question + " " + fill, 3: fill + " " + answer + " " + fill,
        4: fill, 5: ITEM.upper().replace(" ", "\n"), 6: ITEM.replace("old", "new"), 7: " ".join(reversed(ITEM.split())),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    items = spark.createDataFrame([(9, ITEM), (10, words(rng, 30, 500)), (11, None), (12, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()}
    assert {(1, 9), (5, 9)} <= got and not got & {(2, 9), (3, 9), (4, 9), (7, 9)}
    assert {r.doc_id for r in d.without_contaminated(docs, items).collect()} == set(texts) - {g[0] for g in got}


def test_item_longer_than_a_passage(spark):
    rng = random.Random(8)
    long = words(rng, 700, 4000)
    docs = spark.createDataFrame([(1, "x " * 333 + long + " y" * 100), (2, long[: len(long) // 2])], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, long), (2, words(rng, 20, 4000))], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()] == [(1, 1)]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(1)
    texts = [words(rng, 30, 900) for _ in range(25)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = spark.createDataFrame([(k, words(rng, 80, 900) + " " + texts[k]) for k in range(0, 25, 3)], "doc_id bigint, text string")
    whole = rows(d.contaminated(docs, items))
    monkeypatch.setattr(d, "INDEX_BYTES", 1000)
    assert len(d.indexes(items)) > 2
    assert rows(d.contaminated(docs, items)) == whole and {r[:2] for r in whole} >= {(k, k) for k in range(0, 25, 3)}


def test_edge_rows(spark, edge, clashing, empty):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in d.contaminated(edge, items).select("doc_id").distinct().collect()) == [1, 2]
    none = items.where("false")
    assert d.contaminated(edge, none).count() == 0 and d.contaminated(empty, items).count() == 0
    kept = d.without_contaminated(clashing, items)
    assert kept.dtypes == clashing.dtypes and kept.count() == edge.count() - 3
    assert d.without_contaminated(clashing, none).count() == edge.count()


def test_query(spark):
    got = {(r.doc_id, r.item_id) for r in d.op4_decontamination(spark, SF).collect()}
    docs = [(r.doc_id, " ".join(d.words_of(r.text))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, " ".join(d.words_of(r.text))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {(i, j) for i, t in docs for j, b in items if f" {b} " in f" {t} "}
    assert whole and whole <= got and len(got - whole) <= len(whole)


def test_items_without_id(spark):
    other = "Which of the small rivers in the north is said to run dry every year? It is the one that people there call the Lost Maid."
    items = spark.createDataFrame([(None, ITEM), (1, ITEM), (None, ITEM), (None, other), (2, other)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"Before it. {ITEM} After it."), (2, "nothing of it"), (3, None)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()), key=repr)
    assert got == [(1, 1), (1, None), (1, None)]
    assert {r.doc_id for r in d.without_contaminated(docs, items).collect()} == {2, 3}


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(d, "INDEX_BYTES", 60)
    live, most = [], []
    send = type(spark.sparkContext).broadcast

    def counted(self, value):
        sent = send(self, value)
        live.append(sent)
        most.append(len(live))
        end = sent.destroy
        monkeypatch.setattr(sent, "destroy", lambda *a: (live.remove(sent), end(*a)))
        return sent

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    items = spark.createDataFrame([(k, ITEM.replace("Grey", name)) for k, name in enumerate(("Grey", "Red", "Blue"))], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"Before it. {ITEM}"), (1, f"Before it. {ITEM}"), (2, "nothing of it"), (2, "nothing of it"), (3, None)], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(docs, items).collect()} >= {(1, 0)}
    assert sorted(r.doc_id for r in d.without_contaminated(docs, items).collect()) == [2, 2, 3]
    assert len(most) > 2 and set(most) == {1} and not live
