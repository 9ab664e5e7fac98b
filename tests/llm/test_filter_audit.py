import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from snapmart.llm import filter_audit
from snapmart.llm.filter_audit import SQL, WordTable, audit, failed_filters, op13_filter_audit, signals, transduce
from tests.check_oracle import compare, connect
from tests.llm.conftest import EDGE, SF, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    "", " ", "one", "one two one", "  A bC\tD\n", "é日本𝒳 é é", "#$%&*| x", "　  x\x00y", "ab abc ab abcd abc", "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + "y",
    "𝒳" * 50 + "\x0b" + "𝒳" * 50, "a\x1cb a\x1cb", " ".join(f"w{k % 37}" for k in range(5000)),
]


def expected(text):
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def read(texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    return signals(np.frombuffer(b"".join(data), np.uint8), offsets).tolist()


def test_signals():
    assert read(TEXTS) == [expected(t) for t in TEXTS]
    for text in TEXTS:
        assert read([text]) == [expected(text)]


@pytest.mark.parametrize("slices", [1, 7, 64, 1000])
def test_stretches_and_slices_do_not_matter(monkeypatch, slices):
    whole = read(TEXTS)
    monkeypatch.setattr(filter_audit, "_SLICE", slices)
    monkeypatch.setattr(filter_audit, "_STEPS", 3)
    assert read(TEXTS) == whole


def test_stretches_agree_with_a_byte_at_a_time():
    data = np.random.default_rng(1).integers(0, 256, 20_000).astype(np.uint8)
    state, want = 0, []
    for byte in data:
        at = state + filter_audit._CLASS[byte]
        want.append(filter_audit._REPORT[at])
        state = filter_audit._NEXT[at]
    assert transduce(data).tolist() == want


def test_equal_hashes_are_told_apart_by_bytes():
    data = np.frombuffer(b"aa ab aa ab ac" + b"q" * 300 + b" " + b"q" * 300, np.uint8)
    begin = np.array([0, 3, 6, 9, 12, 14, 315])
    end = np.array([2, 5, 8, 11, 14, 314, 615])
    words = WordTable(data, begin, end, np.zeros(7, np.int64))
    assert words.first_of_each(np.zeros(7, np.uint64)).tolist() == [True, True, False, False, True, True, False]
    words.doc = np.arange(7)
    assert words.first_of_each(np.zeros(7, np.uint64)).all()


def brute(docs, labels):
    least = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good, bad = ({i for i, *v in labels if v[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for doc_id, text, lang, *_ in docs:
        n, distinct, capitals, points, symbols = expected(text or "")
        fails = {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * capitals > 3 * points, "D": symbols > 0,
                 "E": doc_id is not None and doc_id > least[text or ""]}
        parts[lang or ""].append(({f for f, x in fails.items() if x}, doc_id in good, doc_id in bad))
    out = []
    for part, members in parts.items():
        shapley, counted = Counter(), []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [m for m in members if f in m[0] and not m[0] & before]
                shapley[f] += len(here)
                counted.append((part, "".join(order), k + 1, f, sum(not m[0] & {*before, f} for m in members), len(here),
                                sum(f in m[0] for m in members) - len(here), sum(m[0] == {f} for m in members),
                                sum(m[1] for m in here), sum(m[2] for m in here)))
        out += [(*c[:3], *c[4:], shapley[c[3]]) for c in counted]
    return sorted(out, key=repr)


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_edge_rows(spark, edge, clashing, empty):
    labels = [(1, 1, 0), (1, 0, 0), (2, None, 1), (6, 1, 1), (None, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = brute(EDGE, [x for x in labels if x[0] is not None])
    for docs in (edge, clashing, edge.repartition(5)):
        got = audit(failed_filters(docs), table)
        assert set(got.columns) == set(NAMES)
        assert rows(got.select(NAMES)) == want
    assert audit(failed_filters(empty), table).count() == 0
    assert audit(failed_filters(edge), table.where("false")).count() == 120 * 5 * 3


def test_random_documents(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Ab", "cd", "ef", "é", "x#", "GH"]) + str(rng.randrange(9) if rng.random() < 0.3 else rng.randrange(10**6)) for _ in range(rng.randrange(150, 260))) for _ in range(60)]
    docs = [(k, rng.choice(texts), rng.choice(["en", "de", None])) for k in range(300)]
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 300, 2)]
    got = audit(
        failed_filters(spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(7)),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )
    assert rows(got.select(NAMES)) == brute(docs, labels)


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), SF, "op13", op13_filter_audit, SQL) is None
