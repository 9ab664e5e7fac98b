"""Audit of how quality filters interact, over documents read once by a byte transducer.

A finite-state table with one row a state and one column a byte class drives the pass over the
UTF-8 bytes: between words, in a word, and in a word with one to three bytes of a code point to
come. The transition that a byte takes says whether a word starts or ends there, whether a code
point is complete, and whether it is a capital or a symbol. Many stretches of a batch advance in
step, a byte each: the state after any four bytes does not depend on the state before them, so a
stretch starts four bytes early and needs no earlier result. The spans of words go into an open
hash table under document and hash; a word is the same as one in the table only if its bytes are.

Spark turns the signals into the verdicts of five filters. The one on repeated texts takes the
smallest id of every text hash (partial minima before the shuffle) and meets the rows again by
hash and id, so rows of a text that a third of all documents hold are spread by their ids. Rows are
counted by part and set of failed filters before the orders of the filters are laid out: a part
has at most 32 sets. A task holds about 4 MB of texts, or one longer text.

Defined cases: a null text counts as empty, and a null part as the empty string; a text without
words does not fail on repeated words; rows with a null id neither fail for a repeated text nor
make others fail; a document has a label if any of its label rows says so; repeated rows with one
id count each and do not repeat each other; bytes that fit no code point count as one each; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.llm.common import table, written

# The filters and what fails them.
FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
WHITE = b" \t\n\x0b\x0c\r"

# Byte classes.
_WHITE, _CAPITAL, _SYMBOL, _OTHER, _MORE, _LEAD2, _LEAD3, _LEAD4 = range(8)
_CLASSES = 8
# States: between words, in a word, and in a word with one, two or three bytes to come.
_GAP, _WORD, _LACKS1, _LACKS2, _LACKS3 = range(5)
_STATES = 5
# What a transition reports.
_BEGIN, _END, _POINT, _UPPER, _MARK = (1 << k for k in range(5))

_LEFT = 4
_STEPS = 256
_SLICE = 4 << 20
_UNIT = 4 << 20
_LONG_WORD = 256


def _class_table() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    out[list(WHITE)] = _WHITE
    out[ord("A") : ord("Z") + 1] = _CAPITAL
    out[list(SYMBOLS)] = _SYMBOL
    out[0x80:0xC0] = _MORE
    out[0xC0:0xE0] = _LEAD2
    out[0xE0:0xF0] = _LEAD3
    out[0xF0:0xF8] = _LEAD4
    return out


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state (times the classes) and report of every state and class."""
    after, report = np.zeros((_STATES, _CLASSES), np.uint8), np.zeros((_STATES, _CLASSES), np.uint8)
    lead = {_LEAD2: _LACKS1, _LEAD3: _LACKS2, _LEAD4: _LACKS3}
    for state in range(_STATES):
        for kind in range(_CLASSES):
            if kind == _WHITE:
                after[state, kind] = _GAP
                report[state, kind] = _POINT | (_END if state != _GAP else 0)
                continue
            begins = _BEGIN if state == _GAP else 0
            if kind in lead:
                after[state, kind], report[state, kind] = lead[kind], begins | _POINT
            elif kind == _MORE and state >= _LACKS1:
                after[state, kind] = state - 1 if state > _LACKS1 else _WORD
            else:
                after[state, kind] = _WORD
                report[state, kind] = begins | _POINT | {_CAPITAL: _UPPER, _SYMBOL: _MARK}.get(kind, 0)
    return after.reshape(-1) * _CLASSES, report.reshape(-1)


_CLASS = _class_table()
_NEXT, _REPORT = _transitions()


def transduce(data: np.ndarray) -> np.ndarray:
    """Reports of all bytes, from the state between words."""
    out = np.empty(len(data), np.uint8)
    for at in range(0, len(data), _SLICE):
        end = min(at + _SLICE, len(data))
        length = -(-(end - at) // max(1, (end - at) // _STEPS))
        stretches = -(-(end - at) // length)
        # White space before the first byte and after the last one.
        held = np.zeros(_LEFT + stretches * length, np.uint8)
        from_ = max(at - _LEFT, 0)
        held[_LEFT - (at - from_) : _LEFT + end - at] = _CLASS[data[from_:end]]
        columns = np.ascontiguousarray(np.lib.stride_tricks.as_strided(held, (stretches, _LEFT + length), (length, 1)).T)
        state = np.zeros(stretches, np.uint8)
        for step in range(_LEFT):
            state = _NEXT[state + columns[step]]
        taken = np.empty((length, stretches), np.uint8)
        for step in range(length):
            now = np.add(state, columns[_LEFT + step], out=taken[step])
            state = _NEXT[now]
        out[at:end] = _REPORT[taken.T.reshape(-1)[: end - at]]
    return out


class WordTable:
    """Open hash table of word spans; spans are equal if document, length and all bytes are."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray):
        self.data, self.begin, self.size, self.doc = data, begin, end - begin, doc
        # Eight bytes from any place on, zeros after the last byte.
        self.padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eights = np.ndarray((len(data) + 1,), "<u8", self.padded.data, strides=(1,))
        # Bytes of the last eight that belong to the word.
        self.masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

    def _eight(self, words: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of words that have them, zeros after the end."""
        return self.eights[self.begin[words] + 8 * k] & self.masks[np.minimum(self.size[words] - 8 * k, 8)]

    def _bytes(self, word: int) -> np.ndarray:
        return self.data[self.begin[word] : self.begin[word] + self.size[word]]

    def hashes(self) -> np.ndarray:
        mixed = np.uint64(0x9E3779B97F4A7C15)
        out = (self.doc.astype(np.uint64) << np.uint64(32)) ^ self.size.astype(np.uint64)
        words, k = np.flatnonzero(self.size <= _LONG_WORD), 0
        while len(words):
            x = (out[words] ^ self._eight(words, k)) * mixed
            out[words] = x ^ (x >> np.uint64(29))
            k += 1
            words = words[self.size[words] > 8 * k]
        for word in np.flatnonzero(self.size > _LONG_WORD):
            out[word] ^= np.uint64(hash(self._bytes(word).tobytes()) & 0xFFFFFFFFFFFFFFFF)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    def _equal(self, some: np.ndarray, others: np.ndarray) -> np.ndarray:
        same = (self.doc[some] == self.doc[others]) & (self.size[some] == self.size[others])
        left, k = np.flatnonzero(same & (self.size[some] <= _LONG_WORD)), 0
        while len(left):
            unlike = self._eight(some[left], k) != self._eight(others[left], k)
            same[left[unlike]] = False
            k += 1
            left = left[~unlike]
            left = left[self.size[some[left]] > 8 * k]
        for n in np.flatnonzero(same & (self.size[some] > _LONG_WORD)):
            same[n] = np.array_equal(self._bytes(some[n]), self._bytes(others[n]))
        return same

    def first_of_each(self, hashes: np.ndarray | None = None) -> np.ndarray:
        """True for every word that is not in the table before it is inserted."""
        hashes = self.hashes() if hashes is None else hashes
        n = len(hashes)
        first = np.zeros(n, bool)
        places = 1 << max(3, (2 * n).bit_length())
        held = np.full(places, -1, np.int64)
        at = (hashes & np.uint64(places - 1)).astype(np.int64)
        waiting = np.arange(n)
        while len(waiting):
            slots = at[waiting]
            free = np.flatnonzero(held[slots] < 0)
            # Of several words for one free place the first takes it.
            held[slots[free][::-1]] = waiting[free][::-1]
            owner = held[slots]
            mine = owner == waiting
            first[waiting[mine]] = True
            waiting, owner = waiting[~mine], owner[~mine]
            known = hashes[waiting] == hashes[owner]
            known[known] = self._equal(waiting[known], owner[known])
            waiting = waiting[~known]
            at[waiting] = (at[waiting] + 1) & (places - 1)
        return first


SIGNALS = ("words", "distinct", "capitals", "points", "symbols")


def signals(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of `SIGNALS` for each of the texts that lie in `data` between `offsets`."""
    n = len(offsets) - 1
    # White space after every text ends its last word and sets the state back.
    spaced = np.insert(data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0], ord("\n"))
    starts = offsets[:-1] - offsets[0] + np.arange(n)
    report = transduce(spaced)

    def count(kind: int) -> np.ndarray:
        return np.add.reduceat((report & kind) != 0, starts, dtype=np.int64)

    begin, end = np.flatnonzero(report & _BEGIN), np.flatnonzero(report & _END)
    words = count(_BEGIN)
    doc = np.repeat(np.arange(n), words)
    distinct = np.bincount(doc[WordTable(spaced, begin, end, doc).first_of_each()], minlength=n)
    return np.stack([words, distinct, count(_UPPER), count(_POINT) - 1, count(_MARK)], 1)


def _signals(text: pa.Array) -> pa.Array:
    large = text.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(large.buffers()[2] or b"", np.uint8)
    parts, at = [np.zeros((0, len(SIGNALS)), np.int64)], 0
    while at < len(large):
        # Whole texts of about a unit, or one that is longer.
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _UNIT, "right")) - 1)
        parts.append(signals(data, offsets[at : end + 1]))
        at = end
    return pa.StructArray.from_arrays([pa.array(c) for c in np.concatenate(parts).T.copy()], list(SIGNALS))


def document_signals(text: Column) -> Column:
    """struct(words, distinct, capitals, points, symbols) of a text that is not null."""
    return F.arrow_udf(_signals, f"struct<{','.join(f'{s}:bigint' for s in SIGNALS)}>")(text)


def _bits(fails: dict[str, Column]) -> Column:
    mask = F.lit(0)
    for letter, failed in fails.items():
        mask += F.when(failed, 1 << FILTERS.index(letter)).otherwise(0)
    return mask


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every row: bit k is set if the k-th filter fails."""
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), document_signals(F.col("text")).alias("s"))
    s = F.col("s")
    own = _bits(
        {
            "A": s["words"] < LEAST_WORDS,
            "B": 100 * s["distinct"] < DISTINCT_PERCENT * s["words"],
            "C": 100 * s["capitals"] > CAPITAL_PERCENT * s["points"],
            "D": s["symbols"] > 0,
        }
    )
    # Texts are read once: what follows meets a small table.
    return with_repeats(written(found.select("doc_id", "part", "sha", own.alias("mask")), "audit-signals"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds the last filter's bit to `mask`: the text hash occurs under a smaller id."""
    known, unknown = rows.where("doc_id is not null"), rows.where("doc_id is null")
    least = known.groupBy("sha").agg(F.min("doc_id").alias("least"))
    first = least.select(F.col("sha").alias("own_sha"), "least")
    judged = known.join(first, (known["doc_id"] == first["least"]) & (known["sha"] == first["own_sha"]), "left")
    bit = F.when(F.col("least").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return judged.select("doc_id", "part", (F.col("mask") + bit).alias("mask")).unionByName(unknown.select("doc_id", "part", "mask"))


def audit(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of every part, order of the filters and step, from (doc_id, part, mask)."""
    marked = labels.groupBy(F.col(id_col).alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    good, bad = (F.count_if(F.col(c) == 1).alias(c) for c in ("good", "bad"))
    known = failed.where("doc_id is not null").join(marked, F.col("doc_id") == F.col("label_id"), "left")
    unknown = failed.where("doc_id is null").select("part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("bad"))
    rows = known.select("part", "mask", "good", "bad").unionByName(unknown)
    sets = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), good, bad)
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            steps.append(("".join(order), step, letter, bit, before))
            before |= bit
    laid = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"l":"{x}","b":{b},"p":{p}}}' for o, s, x, b, p in steps) + "]"),
        "array<struct<o:string,s:int,l:string,b:int,p:int>>",
    )
    bits, mask = F.col("x"), F.col("mask")
    reached, fails = mask.bitwiseAND(bits["p"]) == 0, mask.bitwiseAND(bits["b"]) != 0
    taken = lambda condition, count="n": F.sum(F.when(condition, F.col(count)).otherwise(0))
    counted = (
        sets.withColumn("x", F.explode(laid))
        .groupBy("part", bits["o"].alias("filter_order"), bits["s"].alias("step"), bits["l"].alias("letter"))
        .agg(
            taken(reached & ~fails).alias("kept"),
            taken(reached & fails).alias("removed"),
            taken(~reached & fails).alias("redundant"),
            taken(mask == bits["b"]).alias("unique_fails"),
            taken(reached & fails, "good").alias("good_lost"),
            taken(reached & fails, "bad").alias("toxic_lost"),
        )
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return counted.withColumn("shapley", shapley).drop("letter")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failed_filters(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


#: The same result in DuckDB's SQL.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents
), m AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM t
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), s AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE bad = 1) AS bad
  FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY part, mask
), f(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), p AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(list_concat([0], bits[1:step - 1])) AS INTEGER) AS before
  FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)
), c AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM s, p GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM c
"""
