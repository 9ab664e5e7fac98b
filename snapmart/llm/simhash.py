"""Near-duplicate classes of SimHash fingerprints, with candidates by the pigeonring principle.

Fingerprints: A-Z lowered, words cut at ASCII white space, XXH64 (seed 42) of each shingle of
`shingle` words, repeats included; a bit is set if it is set in over half of the hashes.

Candidates: with a limit of t bits the fingerprint is cut into t + 1 segments on a ring. If two
fingerprints differ in t bits at most, some segment starts a chain in which the first l
segments differ in at most l * t / (t + 1) bits, for every l: none in the first, one in the
first two, and so on. The first two budgets are join keys: a segment, and the next one as it
is or with one zero bit set, as one of two that differ in a bit has the zero. The longer chains
prune what the join finds before the full check.

Dense groups: only distinct fingerprints are linked. Where many share a key, they are linked
to the key's most frequent fingerprint where near enough; pairs of which both are linked to it
are in one class already and are not formed, while all others are. So no link is lost between
classes, and a group of near copies costs rows in proportion to its size.

Defined cases: a null or empty text has fingerprint zero, linked like any other; texts with
fewer words than a shingle hash as a whole; a null id never is a class's id unless all ids in
the class are null; repeated rows get equal results; an empty table gives no rows; long texts
are hashed in pieces of bounded size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import join_hot, packed, table, unpacked, written
from snapmart.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints with one key from which on they are linked through the most frequent one.
DENSE_KEY = 4
#: Bytes of the table of crowded classes up to which it is broadcast.
BROADCAST_BYTES = 16 << 20
#: Shingles hashed at once: bounds the memory of long texts.
SHINGLES_AT_ONCE = 1 << 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash."""
    import xxhash

    # On bytes, split() cuts at the six ASCII white space characters and at nothing else.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    if len(words) > shingle:
        ends = ends[shingle - 1 :]
    else:
        ends = ends[-1:]
    starts = starts[:n]
    one = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        some = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array([one(joined[a:b], SEED) for a, b in zip(starts[some].tolist(), ends[some].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * counts > n)))


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, prints(F.col(text_col).cast("string")))


def _segments(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of bits + 1 segments."""
    cuts = [64 * k // (bits + 1) for k in range(bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _part(fp: Column, segment: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, segment[0]).bitwiseAND(F.lit((1 << segment[1]) - 1))


def _mask(segments: list[tuple[int, int]]) -> int:
    mask = sum(((1 << w) - 1) << a for a, w in segments)
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(fp: Column, bits: int, turned: bool) -> Column:
    """Keys (ring position, segment, next segment); `turned` adds those with one more bit set in the next segment."""
    ring = _segments(bits)
    keys = []
    for k, segment in enumerate(ring):
        after = ring[(k + 1) % len(ring)]
        first, second = F.shiftleft(_part(fp, segment), after[1]), _part(fp, after)
        for bit in [0] + [1 << b for b in range(after[1])] * turned:
            key = F.struct(F.lit(k).alias("ring"), first.bitwiseOR(second.bitwiseOR(F.lit(bit))).alias("part"))
            keys.append(F.when(second.bitwiseAND(F.lit(bit)) == 0, key) if bit else key)
    return F.filter(F.array(*keys), lambda key: key.isNotNull())


def _near(a: str, b: str, bits: int) -> Column:
    """The chain's longer budgets for the pair's ring position, then the full distance."""
    ring = _segments(bits)
    differ = F.col(a).bitwiseXOR(F.col(b))
    chains = F.lit(False)
    for k in range(len(ring)):
        fits = F.col("ring") == k
        for length in range(3, len(ring)):
            some = [ring[(k + j) % len(ring)] for j in range(length)]
            fits &= F.bit_count(differ.bitwiseAND(F.lit(_mask(some)))) <= length * bits // len(ring)
        chains |= fits
    return chains & (F.bit_count(differ) <= bits)


def links(prints: DataFrame, bits: int = MAX_BITS, dense: int = DENSE_KEY) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints of `prints` (fp, n) within `bits` into classes."""
    if bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    base = prints.select("fp", "n", F.explode(_keys(F.col("fp"), bits, False)).alias("k")).select("fp", "n", "k.*")
    probe = prints.select("fp", F.explode(_keys(F.col("fp"), bits, True)).alias("k")).select("fp", "k.*")
    centres = (
        base.groupBy("ring", "part")
        .agg(F.count("*").alias("held"), F.max(F.struct("n", "fp")).alias("top"))
        .where(F.col("held") >= dense)
        .select("ring", "part", F.col("top.fp").alias("centre"))
    )
    on_centre = F.coalesce(F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= bits, F.lit(False))
    base = base.drop("n").join(centres, ["ring", "part"], "left").withColumn("on", on_centre)
    probe = probe.join(centres, ["ring", "part"], "left").withColumn("on", on_centre)
    a, b = probe.select("ring", "part", F.col("fp").alias("a"), "on"), base.select("ring", "part", F.col("fp").alias("b"), "on")
    # Off the centre on one side is enough; a pair meets under the probe of one of its two at least.
    off = a.where("not on").drop("on").join(b.drop("on"), ["ring", "part"]).where(F.col("a") != F.col("b"))
    to_off = a.where("on").drop("on").join(b.where("not on").drop("on"), ["ring", "part"])
    pairs = off.unionByName(to_off).where(_near("a", "b", bits)).select("a", "b")
    stars = probe.where("on").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    return pairs.unionByName(stars)


def near_duplicate_classes(prints: DataFrame, bits: int = MAX_BITS, name: str = "simhash") -> DataFrame:
    """(fp, label) of all fingerprints linked to another one; `prints` has distinct fp and their counts n."""
    return components(links(prints, bits), name).select(F.col("node").alias("fp"), "label")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = written(with_fingerprint(narrow, "text", "fp", shingle).select("doc_id", "fp"), "simhash-prints")
    distinct = written(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "simhash-distinct")
    classes = near_duplicate_classes(distinct.select("fp", "n"), bits)
    held = distinct.agg(F.count("*").alias("prints"), F.sum("n").alias("rows")).first()
    labelled = written(
        distinct.join(classes, "fp", "left").select("fp", "n", "least", F.coalesce("label", "fp").alias("label")), "simhash-labels"
    )
    firsts = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    of_print = written(join_hot(labelled, firsts, "label", "prints", held.prints).select("fp", "n", "component_id"), "simhash-classes")
    joined = join_hot(prints, of_print, "fp", "n", held.rows or 0)
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each_class(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """The rows of `docs` less near duplicates: of each class the row with the smallest id (null last) stays.

    Of rows alike in id and text one stays.
    """
    keyed = packed(docs, "row").withColumns({"own_id": F.col(f"row.`{id_col}`"), "own_text": F.col(f"row.`{text_col}`")})
    keyed = written(with_fingerprint(keyed, "own_text", "fp", shingle).withColumn("rid", F.monotonically_increasing_id()), "simhash-rows")
    rank = F.struct(F.col("own_id").isNull().alias("no_id"), F.col("own_id").alias("id"), "rid")
    distinct = written(keyed.groupBy("fp").agg(F.count("*").alias("n"), F.min(rank).alias("first")), "simhash-distinct")
    classes = near_duplicate_classes(distinct.select("fp", "n"), bits, "simhash-docs")
    held = distinct.agg(F.count("*").alias("prints"), F.sum("n").alias("rows")).first()
    labelled = written(distinct.join(classes, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "simhash-labels")
    best = labelled.groupBy("label").agg(F.min("first").alias("best"), F.sum("n").alias("members"), F.count("*").alias("prints"))
    # Only rows of classes with more than one member can go.
    joined = join_hot(labelled, best.where("members > 1"), "label", "prints", held.prints)
    crowded = written(joined.select("fp", "n", F.col("best.rid").alias("stays")), "simhash-crowded")
    # Two longs a row: broadcast while that is small, else only frequent fingerprints are and the others shuffled.
    if crowded.count() * 16 <= BROADCAST_BYTES:
        kept = keyed.join(F.broadcast(crowded.drop("n")), "fp", "left")
    else:
        kept = join_hot(keyed, crowded, "fp", "n", held.rows, "left")
    kept = kept.where("stays is null or stays = rid")
    return unpacked(kept, "row", {}).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
