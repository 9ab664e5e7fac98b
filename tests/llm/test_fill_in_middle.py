import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.llm.fill_in_middle import SQL, SkipList, cut_points, fill_in_middle, op11_fill_in_middle, restored, unit_widths
from tests.check_oracle import compare, connect
from tests.llm.conftest import CLASHING, EDGE, SF, rows

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TEXTS = ["", "a", " ", "ab cd", "é日本𝒳x", "a\x00b\n\r\n", "[`{@Zz", "word " * 3000 + "end", "x" * 5000, "-" * 5000]


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("text", TEXTS)
def test_widths_are_those_of_the_pattern(text):
    assert unit_widths(text).tolist() == [len(u) for u in UNIT.findall(text)]


def test_letters_run_over_blocks(monkeypatch):
    monkeypatch.setattr("snapmart.llm.fill_in_middle._BLOCK", 3)
    for text in ("abcdefgh ij", "ab.cdé fgh", "   abc   "):
        assert unit_widths(text).tolist() == [len(u) for u in UNIT.findall(text)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 64, 3000])
def test_descent_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    units = SkipList(widths)
    assert [units.offset(r) for r in range(n + 1)] == [0, *np.cumsum(widths).tolist()]
    with pytest.raises(IndexError):
        units.offset(n + 1)


def test_lanes_thin_out_and_keep_all_widths():
    units = SkipList(np.full(100_000, 3))
    sizes = [len(points) for _, points, _ in units.lanes]
    assert all(2 < a / b < 8 for a, b in zip(sizes, sizes[1:]) if b > 50) and sizes[-1] <= 4
    assert all(points.sum() == 300_000 for _, points, _ in units.lanes)
    assert all(steps.sum() == 100_000 for steps, _, _ in units.lanes[1:])


def test_cut_points_of_a_very_long_text():
    text = "véry long, " * 300_000
    units = UNIT.findall(text)
    n, first, second = cut_points(text, 2_345_678, 987_654_321)
    a, b = sorted(x % (len(units) + 1) for x in (2_345_678, 987_654_321))
    assert (n, first, second) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_rows_and_round_trip(spark, edge, clashing, empty):
    marks = [(100 + k, t) for k, t in enumerate(["a<P>b", "<<S", "<M", "x<S>", "<<P<S<M b", "<", "<P"] * 12)]
    docs = spark.createDataFrame(marks, "doc_id bigint, text string")
    for some, given in ((edge, EDGE), (clashing, EDGE), (edge.repartition(3), EDGE), (docs, marks)):
        made = fill_in_middle(some)
        want = sorted([brute(*row[:2]) for row in given], key=repr)
        assert rows(made.drop("text")) == want
        assert made.where(restored(F.col("output"), F.col("form")) != F.col("text")).count() == 0
    assert set(CLASHING).isdisjoint({"output", "form"})
    assert fill_in_middle(empty).count() == 0


def test_shares_follow_the_parameters(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    made = fill_in_middle(docs, seed=7, plain_percent=30, suffix_first_percent=50)
    counts = {r.form: r["count"] for r in made.groupBy("form").count().collect()}
    assert abs(counts["plain"] - 1200) < 150 and abs(counts["spm"] - 1400) < 150 and abs(counts["psm"] - 1400) < 150


def test_query_matches_sql(spark):
    assert compare(spark, connect(SF), SF, "op11", op11_fill_in_middle, SQL) is None
