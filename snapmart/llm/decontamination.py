"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

Items are cut into parts of at most `PART` words, which the index holds. Impacts are BM25 term
scores divided by the part's score for itself, so that a passage that holds a whole part scores
one. Each document is cut into passages that overlap by half, and the distinct words of every
passage are a query: block-max WAND returns all parts that score at least `LEAST_SCORE`. A
passage is first held against the sum of its words' largest impacts, an upper bound that WAND
starts from as well, so that most passages end there.

What is found is verified near the passage: at least 0.8 of the five-word shingles of the
item's question, and of its answer, must occur there. The answer is the last sentence of an
item, or the second half of the words of an item of one sentence; parts with fewer than five
words count as one shingle.

The index is built in blocks of items of bounded size; statistics of words (how many parts hold
them) cover all items. Blocks are built, sent to all tasks and dropped one after the other, and
what each one finds is written. So a larger test set takes more passes over the documents, not
more memory. Every document is read whole.

Defined cases: null or empty texts and items without words match nothing; items with equal
texts are each reported, as are items without an id; an item is reported once a document with its best score; repeated rows
are reported each; an empty table on either side gives no rows and drops no document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import packed, table, union_all, unpacked, written

K1, B = 1.2, 0.75
#: Words of an indexed part at most; passages have twice as many and overlap by half.
PART = 64
LEAST_SCORE = 0.6
LEAST_OVERLAP = 0.8
SHINGLE = 5
#: Parts in a block, and bytes of item texts in one index.
BLOCK = 4
INDEX_BYTES = 16 << 20
#: Cells of a table of block bounds, and passages of a text that are looked at together.
TABLE_CELLS, PASSAGES_AT_ONCE = 4 << 20, 1024

_WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.?!:]\s+|\n")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    sentences = [s for s in map(words_of, _SENTENCE_END.split(text)) if s]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = words_of(text)
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def parts_of(words: list[str]) -> list[list[str]]:
    n = -(-len(words) // PART)
    size = -(-len(words) // n) if n else 1
    return [words[k : k + size] for k in range(0, len(words), size)]


class Index:
    """Postings with normalised impacts, and their largest values by word and by block of parts.

    Parts are numbered by length, so that those of a block have impacts of a like size.
    """

    def __init__(self, items: list[tuple[int, str]], held_by: dict[str, int], n_parts: int, mean_words: float):
        self.items = [(i, *question_and_answer(text)) for i, text in items]
        parts = sorted(((p, k) for k, (_, text) in enumerate(items) for p in parts_of(words_of(text))), key=lambda x: len(x[0]))
        self.item_of = [k for _, k in parts]
        raw: dict[str, list[tuple[int, float]]] = {}
        for number, (part, _) in enumerate(parts):
            counts = Counter(part)
            norm = K1 * (1 - B + B * len(part) / mean_words)
            impact = {
                w: np.log(1 + (n_parts - held_by[w] + 0.5) / (held_by[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                for w, n in counts.items()
            }
            total = sum(impact.values())
            for w, x in impact.items():
                raw.setdefault(w, []).append((number, float(x / total)))
        self.term = {w: t for t, w in enumerate(raw)}
        self.parts = [[p for p, _ in raw[w]] for w in raw]
        self.impacts = [[x for _, x in raw[w]] for w in raw]
        self.blocks: list[dict[int, float]] = []
        for own, impacts in zip(self.parts, self.impacts):
            most: dict[int, float] = {}
            for p, x in zip(own, impacts):
                most[p // BLOCK] = max(most.get(p // BLOCK, 0.0), x)
            self.blocks.append(most)
        self.block_ids = [np.fromiter(m, np.int64, len(m)) for m in self.blocks]
        self.block_most = [np.fromiter(m.values(), np.float64, len(m)) for m in self.blocks]
        self.n_blocks = -(-len(parts) // BLOCK)
        self.most = np.array([max(xs) for xs in self.impacts] + [0.0])
        # The same bounds as a table, where that is small: a passage's bounds are a sum of its rows.
        self.table = None
        if len(self.most) * self.n_blocks <= TABLE_CELLS:
            self.table = np.zeros((len(self.most), self.n_blocks), np.float32)
            for t, (ids, most) in enumerate(zip(self.block_ids, self.block_most)):
                self.table[t, ids] = most

    def live_blocks(self, terms: list[int], least: float) -> list[int]:
        """Blocks whose largest impacts add up to `least` for the query."""
        if not terms:
            return []
        ids = np.concatenate([self.block_ids[t] for t in terms])
        bounds = np.bincount(ids, np.concatenate([self.block_most[t] for t in terms]), self.n_blocks)
        return np.flatnonzero(bounds >= least - 1e-9).tolist()

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All parts that score at least `least` for a query of distinct terms, by block-max WAND.

        Blocks whose bound is too small are passed over; within the others cursors move to the
        pivot, the first part whose words' bounds in the block can add up to enough.
        """
        found = []
        for block in self.live_blocks(terms, least):
            stop = (block + 1) * BLOCK
            bound = {t: self.blocks[t][block] for t in terms if block in self.blocks[t]}
            cursors = []
            for t in bound:
                at = bisect_left(self.parts[t], block * BLOCK)
                cursors.append((self.parts[t][at], at, t))
            while cursors:
                cursors.sort()
                total, pivot = 0.0, -1
                for k, (_, _, t) in enumerate(cursors):
                    total += bound[t]
                    if total >= least - 1e-9:
                        pivot = k
                        break
                if pivot < 0:
                    break
                part = cursors[pivot][0]
                if cursors[0][0] == part:
                    same = [c for c in cursors if c[0] == part]
                    score = sum(self.impacts[t][at] for _, at, t in same)
                    if score >= least - 1e-9:
                        found.append((part, score))
                    moved, target = len(same), part + 1
                else:
                    moved, target = pivot, part
                rest = cursors[moved:]
                for _, at, t in cursors[:moved]:
                    at = bisect_left(self.parts[t], target, at)
                    if at < len(self.parts[t]) and self.parts[t][at] < stop:
                        rest.append((self.parts[t][at], at, t))
                cursors = rest
        return found

    def overlaps(self, item: int, near: list[str]) -> tuple[float, float]:
        """Shares of the question's and the answer's shingles that occur in `near`."""
        out, held = [], {}
        for part in self.items[item][1:]:
            size = max(1, min(SHINGLE, len(part)))
            if size not in held:
                held[size] = {tuple(near[k : k + size]) for k in range(len(near) - size + 1)}
            own = {tuple(part[k : k + size]) for k in range(len(part) - size + 1)}
            out.append(len(own & held[size]) / len(own) if own else 1.0)
        return out[0], out[1]

    def hopeful(self, ids: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(start, end, distinct terms) of the passages that some block's bound lets through."""
        none = len(self.most) - 1
        n = max(1, -(-(len(ids) - PART) // PART))
        for first in range(0, n, PASSAGES_AT_ONCE):
            last = min(n, first + PASSAGES_AT_ONCE)
            place = np.arange(first * PART, min(len(ids), (last + 1) * PART))
            # A word lies in the passage that starts at its part and in the one before.
            keys = np.concatenate([(place // PART - back) * len(self.most) + ids[place] for back in (0, 1)])
            keys = np.unique(keys[(keys >= first * len(self.most)) & (keys < last * len(self.most))])
            passages, terms = np.divmod(keys, len(self.most))
            passages, terms = passages[terms != none], terms[terms != none]
            cuts = np.flatnonzero(np.diff(passages, prepend=-1))
            if not len(cuts):
                continue
            if self.table is not None:
                live = (np.add.reduceat(self.table[terms], cuts).max(1) >= LEAST_SCORE - 1e-4).tolist()
            else:
                live = (np.add.reduceat(self.most[terms], cuts) >= LEAST_SCORE - 1e-9).tolist()
            for hope, a, b in zip(live, cuts.tolist(), [*cuts[1:].tolist(), len(terms)]):
                if hope:
                    start = int(passages[a]) * PART
                    yield start, min(len(ids), start + 2 * PART), terms[a:b].tolist()

    def matches(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Item number: best score, question overlap, answer overlap, for a whole text."""
        words = words_of(text)
        best: dict[int, tuple[float, float, float]] = {}
        if not words:
            return best
        get, none = self.term.get, len(self.most) - 1
        ids = np.array([get(w, none) for w in words], np.int64)
        for a, b, terms in self.hopeful(ids):
            for part, score in self.search(terms, LEAST_SCORE):
                item = self.item_of[part]
                span = len(self.items[item][1]) + len(self.items[item][2])
                question, answer = self.overlaps(item, words[max(0, a - span) : b + span])
                if min(question, answer) >= LEAST_OVERLAP:
                    best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (score, question, answer))
        return best


class Indexes:
    """The indexes of all blocks of items, each built when it is asked for."""

    def __init__(self, items: DataFrame, n_parts: int, mean_words: float, blocks: int):
        self.items, self.n_parts, self.mean_words, self.blocks = items, n_parts, mean_words, blocks

    def __len__(self) -> int:
        return self.blocks

    def __getitem__(self, block: int) -> Index:
        if not 0 <= block < self.blocks:
            raise IndexError(block)
        some = self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks)) == block)
        found = [(r.item_id, r.text) for r in some.collect() if words_of(r.text)]
        rows = sorted(found, key=lambda x: (x[1], x[0] is None, x[0]))
        # Only the words of this block: their number is bounded by its size.
        wanted = _terms(some).select("word").distinct()
        held_by = _terms(self.items).groupBy("word").agg(F.count("*").alias("n"))
        counts = {r.word: r.n for r in held_by.join(wanted, "word", "left_semi").collect()}
        return Index(rows, counts, self.n_parts, self.mean_words)

    def sent(self) -> Iterator:
        """A broadcast of one index at a time, which is gone once the next one is asked for."""
        for block in range(self.blocks):
            index = self.items.sparkSession.sparkContext.broadcast(self[block])
            yield index
            index.destroy()


def _terms(items: DataFrame) -> DataFrame:
    """(word, place, words) of the distinct words of every part of the items."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, n, len(p)) for text in batch["text"] for p in parts_of(words_of(text)) for n, w in enumerate(dict.fromkeys(p))]
            yield pd.DataFrame(rows, columns=["word", "place", "words"])

    return items.select("text").mapInPandas(cut, "word string, place int, words int")


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Indexes:
    """One index for each block of items of bounded size."""
    own = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    shape = _terms(own).where("place = 0").agg(F.count("*").alias("parts"), F.avg("words").alias("mean")).first()
    size = own.agg(F.sum(F.octet_length("text")).alias("size")).first().size if shape.parts else 0
    return Indexes(own, shape.parts, shape.mean, -(-size // INDEX_BYTES))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): every verified item of every row."""
    kind = "item_id bigint, score double, question_overlap double, answer_overlap double"

    def found(index) -> DataFrame:
        @F.pandas_udf(f"array<struct<{kind.replace(' bigint', ':bigint').replace(' double', ':double')}>>")
        def search(texts: pd.Series) -> pd.Series:
            names = ("score", "question_overlap", "answer_overlap")
            return pd.Series(
                [
                    [{"item_id": index.value.items[i][0], **dict(zip(names, map(float, best)))} for i, best in index.value.matches(t).items()]
                    for t in texts
                ]
            )

        narrow = docs.select(F.col(id_col).alias("doc_id"), search(F.col(text_col).cast("string")).alias("found"))
        return narrow.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")

    frames = [written(found(index), "contaminated") for index in indexes(items).sent()]
    return union_all(frames) if frames else docs.sparkSession.createDataFrame([], f"doc_id bigint, {kind}")


def _clean(index):
    """Column function: whether no item of a sent index is verified in a text."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not index.value.matches(t) for t in texts], dtype=bool)

    return clean


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no item is verified."""
    kept = packed(docs, "row")
    text = F.col(f"row.`{text_col}`").cast("string")
    blocks = indexes(items)
    if len(blocks) == 1:
        kept = kept.where(_clean(docs.sparkSession.sparkContext.broadcast(blocks[0]))(text))
    elif len(blocks):
        # Whether an item is found depends on the text alone: each block leaves the hashes of such texts.
        own = F.sha2(text, 256)
        found = [written(kept.where(~_clean(index)(text)).select(own.alias("sha")), "dirty") for index in blocks.sent()]
        dirty = union_all(found).distinct()
        kept = kept.join(dirty, own == dirty["sha"], "left_anti")
    return unpacked(kept, "row", {}).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
