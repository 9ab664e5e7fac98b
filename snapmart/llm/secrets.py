"""Secret scan with corpus-wide ownership of the values found.

Candidates are the spans of three fixed patterns and of a broader one: long runs of key
characters with lower case, upper case and digits. The value of each candidate is hashed, and
the hashes are counted over the whole corpus by distinct repositories and distinct owners. A
value that several owners hold is a copied example; a value of one owner looks live. Spans of
the broader pattern are only reported where they look live and overlap no fixed span.

Only DataFrame functions are used. Positions come from the lengths of the pieces that a pattern
splits a text into; sums over many matches are taken by blocks of blocks. A value's holders are
made distinct by owner and repository, which spreads them by repository, and are then counted
with partial counts. Spans meet the counts of their values; those of values that many spans have
are broadcast, so no task gets all spans of one value.

Defined cases: very long texts are read whole, in time that grows with their length; a null text counts as empty and has no spans; a null owner counts as one owner,
and so does a null repository; repeated rows count once for their repository; an empty table
gives no rows; extra columns are not read. Spans are in code points, the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import join_hot, let, table, written

# The patterns by kind, in the order of their names in results.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")

#: The broader pattern, and what its runs must hold.
OWNED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}"
OWNED_HOLDS = ("[a-z]", "[A-Z]", "[0-9].*[0-9].*[0-9]")

#: A value that this many owners hold is a copied example.
EXAMPLE_OWNERS = 3
_BLOCK = 64


def _running(values: Column, zero: Column, combine, levels: int = 3) -> Column:
    """Combination of each value with all before it: by blocks, and over the blocks' own totals in the same way.

    So a value costs about `_BLOCK` steps a level, however many there are, up to `_BLOCK` to the power of the levels.
    """

    def whole(some: Column) -> Column:
        return F.aggregate(some, zero, combine)

    def single(some: Column) -> Column:
        return F.transform(some, lambda _, k: whole(F.slice(some, F.lit(1), k + 1)))

    if levels == 1:
        return let(values, single)

    def joined(parts: Column) -> Column:
        before = _running(F.concat(F.array(zero), F.transform(parts, whole)), zero, combine, levels - 1)
        return let(
            before,
            lambda b: F.flatten(F.transform(parts, lambda p, k: F.transform(single(p), lambda x: combine(F.get(b, k), x)))),
        )

    def cut(some: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(some), F.lit(1)) - 1) / _BLOCK).cast("int"))
        return F.transform(blocks, lambda b: F.slice(some, b * _BLOCK + 1, _BLOCK))

    return let(let(values, cut), joined)


def _clear_of(spans: Column, others: Column) -> Column:
    """The `spans` that overlap none of the `others`, by one pass over both in the order of their starts."""
    least, most = F.lit(-1).cast("long"), F.lit((1 << 62)).cast("long")
    tagged = F.concat(
        F.transform(others, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind"), s["stop"].alias("stop"), s.alias("span"))),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("kind"), s["stop"].alias("stop"), s.alias("span"))),
    )

    def judged(both: Column) -> Column:
        ends = _running(F.transform(both, lambda x: F.when(x["kind"] == 0, x["stop"]).otherwise(least)), least, lambda a, b: F.greatest(a, b))
        starts = F.reverse(
            _running(
                F.reverse(F.transform(both, lambda x: F.when(x["kind"] == 0, x["start"]).otherwise(most))), most, lambda a, b: F.least(a, b)
            )
        )
        return let(
            F.struct(ends.alias("ends"), starts.alias("starts")),
            lambda e: F.transform(
                F.filter(
                    F.transform(
                        both,
                        lambda x, k: F.struct(
                            x["span"].alias("span"),
                            ((x["kind"] == 1) & (F.get(e["ends"], k) <= x["start"]) & (F.get(e["starts"], k) >= x["stop"])).alias("clear"),
                        ),
                    ),
                    lambda x: x["clear"],
                ),
                lambda x: x["span"],
            ),
        )

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(F.array_sort(tagged), judged)).otherwise(spans)


def spans_of(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Array of struct(start, rank, stop, value) of the non-overlapping matches whose `group` has `least` code points."""
    empty = F.array().cast("array<struct<start:bigint,rank:int,stop:bigint,value:string>>")

    def located(found: Column) -> Column:
        whole, value = found["whole"], found["value"]
        pieces = F.split(text, pattern, -1)
        gaps = F.slice(F.transform(pieces, lambda p: F.length(p).cast("long")), F.lit(1), F.size(whole))
        long = F.transform(whole, lambda w: F.length(w).cast("long"))
        ends = _running(F.zip_with(gaps, long, lambda g, w: g + w), F.lit(0).cast("long"), lambda a, x: a + x)
        rows = F.transform(
            F.arrays_zip(ends.alias("e"), long.alias("l"), value.alias("v")),
            lambda x: F.struct(
                (x["e"] - x["l"]).alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                x["e"].alias("stop"),
                x["v"].alias("value"),
            ),
        )
        return F.filter(rows, lambda r: F.length(r["value"]) >= least)

    def matched(t: Column) -> Column:
        whole = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        value = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else whole
        return let(
            F.struct(whole.alias("whole"), value.alias("value")),
            lambda found: F.when(F.size(found["whole"]) > 0, located(found)).otherwise(empty),
        )

    return F.when(text.rlike(pattern), matched(text)).otherwise(empty)


def _names(spans: Column, order) -> Column:
    """kind:start:end, comma-joined, for sorted spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(F.transform(spans, order)),
            lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["stop"]),
        ),
        ",",
    )


def _by_start(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"))


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str) -> DataFrame:
    """One row per document: rid, doc_id, owner and repository hashes, base and broader spans with hashed values."""
    text = F.col("text")
    hashed = lambda spans: F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), F.sha2(s["value"], 256).alias("sha"))
    )
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.lit("o"), F.col(owner_col)).alias("owner"),
        F.xxhash64(F.lit("r"), F.col(repository_col)).alias("repository"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select(
        "doc_id",
        "owner",
        "repository",
        spans_of(text, "assign", ASSIGN, 2, 6).alias("assign"),
        spans_of(text, "access", ACCESS).alias("access"),
        spans_of(text, "hex", HEX).alias("hex"),
        spans_of(text, "owned", OWNED).alias("broad"),
    )
    base = F.concat("assign", "access", "hex")

    def holds(value: Column) -> Column:
        out = F.lit(True)
        for pattern in OWNED_HOLDS:
            out &= value.rlike(pattern)
        return out

    broad = _clear_of(F.filter("broad", lambda s: holds(s["value"])), F.col("base"))
    return (
        found.withColumn("base", base)
        .withColumn("broad", broad)
        .select("doc_id", "owner", "repository", hashed(F.col("base")).alias("base"), hashed(F.col("broad")).alias("broad"))
        .withColumn("rid", F.monotonically_increasing_id())
    )


def ownership(found: DataFrame) -> DataFrame:
    """(sha, n_repositories, n_owners, n_spans) of every candidate value."""
    values = found.select("owner", "repository", F.explode(F.concat("base", "broad")).alias("s")).select(
        "owner", "repository", F.col("s.sha").alias("sha")
    )
    held = values.groupBy("owner", "repository", "sha").agg(F.count("*").alias("spans"))
    owners = held.groupBy("sha", "owner").agg(F.count("*").alias("n"), F.sum("spans").alias("spans"))
    return owners.groupBy("sha").agg(
        F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"), F.sum("spans").alias("n_spans")
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """(doc_id, base, added, live, examples) of every row: spans, those the method adds, and how the values look."""
    found = written(candidates(docs, id_col, text_col, owner_col, repository_col), "secrets")
    total = found.agg(F.sum(F.size("base") + F.size("broad")).alias("spans")).first().spans or 0
    owners = written(ownership(found), "secret-owners")
    spans = found.select("rid", F.explode(F.concat("base", "broad")).alias("s")).select(
        "rid", F.struct("s.start", "s.rank", "s.stop").alias("span"), F.col("s.sha").alias("sha")
    )
    live = F.col("n_owners") < example_owners
    owned = F.col("span.rank") == KINDS.index("owned")
    judged = (
        join_hot(spans, owners, "sha", "n_spans", total)
        .groupBy("rid")
        .agg(
            F.collect_list(F.when(owned & (F.col("n_owners") == 1), F.col("span"))).alias("added"),
            F.count_if(live).alias("live"),
            F.count_if(~live).alias("examples"),
            F.max("n_owners").alias("most_owners"),
            F.max("n_repositories").alias("most_repositories"),
        )
    )
    none = F.lit(0).cast("long")
    return found.join(judged, "rid", "left").select(
        "doc_id",
        F.transform("base", _by_start).alias("base"),
        F.coalesce("added", F.array().cast("array<struct<start:bigint,rank:int,stop:bigint>>")).alias("added"),
        *[F.coalesce(c, none).alias(c) for c in ("live", "examples", "most_owners", "most_repositories")],
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_names(F.col("base"), _by_start), 256).alias("base_sha256"),
        _names(F.concat("base", "added"), _by_start).alias("spans"),
        F.col("live").alias("n_live"),
        F.col("examples").alias("n_example"),
        "most_owners",
        "most_repositories",
    )
