"""Documents with everything that operators must stand: nulls, empty and long texts, repeats, odd columns."""

import pytest

SF = "/root/testdata/sf0.001"

LONG = "word " * 40_000 + "end"
EDGE = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (2, "alpha  beta\ngamma delta epsilon zeta ", "en", None),
    (3, None, None, None),
    (None, "no id here at all", "en", "b"),
    (None, None, "en", "b"),
    (4, "", "en", "b"),
    (5, " \t\n\x0b\x0c\r", "en", "c"),
    (6, LONG, "en", "c"),
    (7, "é日本𝒳 ▁ \x00  　 ok", "fr", "d"),
    (8, "one", "en", "d"),
]
#: Names that operators use or add.
CLASHING = "row src pos fp sha norm shard slot bucket first second rid own_id own_text kept suspects p label stays n".split()


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F

    return edge.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
