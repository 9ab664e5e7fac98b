"""Toxicity by a classifier chain: each category's linear model sees the earlier ones' probabilities.

Words, their beginnings, and runs of marks are features. On a sample of labelled rows of
bounded size Spark counts them by category; those that clearly go with a category are kept (a
bounded number). A logistic regression is fitted for each category in the order of the chain.
The probabilities of earlier categories, which later models take as inputs, are out-of-fold in
training: predicted by models that did not see the row. Without that, later models would trust
them too much. Training runs in numpy on the driver, over kept features of the sample only; all
documents are scored whole in tasks, and the model that travels there has a bounded size.

Defined cases: a null or empty text has no features and gets the model's prior; a labelled row
counts for the categories whose label is not null; labels without a document are ignored; a
document with several labels counts once for each; a category that has one class only in the
sample gets its constant probability; without labels all probabilities are zero; repeated rows
get equal results; extra columns are kept by `without_toxic` and not read otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import packed, table, unpacked

#: The chain in its order, as conditions on the label table: text of poor quality first.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}
#: Labelled rows in the sample (expected number), and kept features of a category at most.
SAMPLE_ROWS = 12_000
KEPT_FEATURES = 1_500
#: Beginnings of words that are features.
BEGINNINGS = (3, 4, 5, 6, 7)
#: A kept feature is in this many positive rows, and its G statistic and odds are as large.
LEAST_ROWS, LEAST_G, LEAST_ODDS = 4, 8.0, 4.0
FOLDS = 4
ROUNDS, RATE, DECAY = 300, 0.3, 1e-5
LIMIT = 0.5
#: Words that a task remembers with their scores.
REMEMBERED = 200_000

_TOKENS = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")


def tokens(text: str | None) -> list[str]:
    return _TOKENS.findall((text or "").lower())


def features_of(token: str) -> list[str]:
    """The token itself, and the beginnings of a word that are shorter than it."""
    return ["=" + token] + [f"{token[:n]}-" for n in BEGINNINGS if len(token) > n]


@dataclass
class Chain:
    """Features with a weight for each category, and per category the bias and weights of earlier probabilities."""

    names: list[str]
    features: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    earlier: np.ndarray

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """Chain over rows of feature sums (rows, categories)."""
        out = np.zeros_like(sums)
        for c in range(len(self.names)):
            z = sums[:, c] + self.bias[c] + out[:, :c] @ self.earlier[c, :c]
            out[:, c] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return out


def _fit(at, feature, n_rows, n_features, extra, truth) -> tuple[np.ndarray, float, np.ndarray]:
    """Logistic regression with L2 decay by Adam; `extra` are dense columns besides the sparse features."""
    if not len(truth) or truth.min() == truth.max():
        share = (truth.sum() + 0.01) / (len(truth) + 0.02)
        return np.zeros(n_features), float(np.log(share / (1 - share))), np.zeros(extra.shape[1])
    w = np.zeros(n_features + extra.shape[1] + 1)
    w[-1] = np.log(truth.mean() / (1 - truth.mean()))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(at, w[feature], n_rows) + extra @ w[n_features:-1] + w[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - truth
        grad = np.concatenate([np.bincount(feature, miss[at], n_features), extra.T @ miss, [miss.sum()]]) / n_rows
        grad[:-1] += DECAY * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:n_features], float(w[-1]), w[n_features:-1]


def fit_chain(names: list[str], features: list[str], rows: list[tuple[list[int], list[float | None]]], folds: int = FOLDS) -> Chain:
    """The chain from rows of (feature numbers, labels; None where not known)."""
    at = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    feature = np.fromiter((k for f, _ in rows for k in f), np.int64, len(at))
    labels = np.array([[np.nan if y is None else y for y in ys] for _, ys in rows], float).reshape(len(rows), len(names))
    fold = np.arange(len(rows)) % folds
    weights = np.zeros((len(features), len(names)))
    bias, earlier = np.zeros(len(names)), np.zeros((len(names), len(names)))
    held_out = np.zeros((len(rows), len(names)))

    def fit(chosen: np.ndarray, c: int):
        number = np.cumsum(chosen) - 1
        inside = chosen[at]
        return _fit(number[at[inside]], feature[inside], int(chosen.sum()), len(features), held_out[chosen, :c], labels[chosen, c])

    for c in range(len(names)):
        known = ~np.isnan(labels[:, c])
        weights[:, c], bias[c], earlier[c, :c] = fit(known, c)
        if not known.any():
            bias[c] = -np.inf
            continue
        for k in range(folds):
            w, b, e = fit(known & (fold != k), c)
            rest = fold == k
            z = np.bincount(at, w[feature], len(rows)) + held_out[:, :c] @ e + b
            held_out[rest, c] = 1 / (1 + np.exp(-np.clip(z[rest], -500, 500)))
    return Chain(names, {f: k for k, f in enumerate(features)}, weights, np.nan_to_num(bias, neginf=-500), earlier)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on labelled documents; `categories` are SQL conditions on the columns of `labels`."""
    names = list(categories)
    share = min(1.0, SAMPLE_ROWS / max(labels.count(), 1))
    chosen = labels.where(F.shiftrightunsigned(F.xxhash64(id_col, F.lit("chain")), 11) < int(share * (1 << 53))).select(
        F.col(id_col).alias("labelled"), *[F.expr(rule).cast("double").alias(f"y{k}") for k, rule in enumerate(categories.values())]
    )
    ys = [f"y{k}" for k in range(len(names))]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        chosen, F.col("doc_id") == F.col("labelled")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict[str, list[float]] = {}
            for text, *y in zip(batch["text"], *(batch[c] for c in ys)):
                seen = {f for t in set(tokens(text)) for f in features_of(t)} | {""}
                for f in seen:
                    sums = held.setdefault(f, [0.0] * (2 * len(y)))
                    for c, v in enumerate(y):
                        if v == v and v is not None:
                            sums[2 * c + (v < 0.5)] += 1
            yield pd.DataFrame([(f, *s) for f, s in held.items()], columns=["feature", *counts])

    counts = [f"{side}{k}" for k in range(len(names)) for side in ("pos", "neg")]
    totals = (
        rows.select("text", *ys)
        .mapInPandas(count, "feature string, " + ", ".join(f"{c} double" for c in counts))
        .groupBy("feature")
        .agg(*[F.sum(c).alias(c) for c in counts])
        .persist()
    )
    whole = totals.where("feature = ''").first()
    features: list[str] = []
    for k in range(len(names)):
        if whole is None or not whole[f"pos{k}"] or not whole[f"neg{k}"]:
            continue
        pos, neg = F.col(f"pos{k}"), F.col(f"neg{k}")
        expected = (pos + neg) * whole[f"pos{k}"] / (whole[f"pos{k}"] + whole[f"neg{k}"])
        g = pos * F.log((pos + 0.01) / expected)
        odds = ((pos + 0.1) / whole[f"pos{k}"]) / ((neg + 0.1) / whole[f"neg{k}"])
        kept = (
            totals.where((F.col("feature") != "") & (pos >= LEAST_ROWS))
            .withColumns({"g": g, "odds": odds})
            .where(f"g >= {LEAST_G} and odds >= {LEAST_ODDS}")
            .orderBy(F.desc("g"), "feature")
            .limit(KEPT_FEATURES)
        )
        features += [r.feature for r in kept.select("feature").collect()]
    totals.unpersist()
    features = sorted(set(features))
    number = rows.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(features)})

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [
                sorted(number.value[f] for t in set(tokens(text)) for f in features_of(t) if f in number.value)
                for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "hits": hits, **{c: batch[c] for c in ys}})

    kind = "doc_id bigint, hits array<int>, " + ", ".join(f"{c} double" for c in ys)
    sample = rows.select("doc_id", "text", *ys).mapInPandas(vectors, kind).collect()
    sample.sort(key=lambda r: (r.doc_id, list(r.hits)))
    return fit_chain(names, features, [(list(r.hits), [r[c] for c in ys]) for r in sample])


def score(text: Column, chain: Chain, spark: SparkSession) -> Column:
    """Struct of the categories' probabilities."""
    model = spark.sparkContext.broadcast(chain)

    @F.pandas_udf(", ".join(f"{n} double" for n in chain.names))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        chain = model.value
        known: dict[str, int] = {}
        weights = [np.zeros(len(chain.names))]

        def weight_of(token: str) -> int:
            """Number of the token's weights; 0 for tokens without a kept feature."""
            hits = [chain.features[f] for f in features_of(token) if f in chain.features]
            if hits:
                weights.append(chain.weights[hits].sum(0))
            if len(known) >= REMEMBERED:
                known.clear()
                del weights[1:-1]
            known[token] = len(weights) - 1 if hits else 0
            return known[token]

        for texts in batches:
            sums = np.zeros((len(texts), len(chain.names)))
            for k, text in enumerate(texts):
                for token in set(tokens(text)):
                    at = known.get(token)
                    if at is None:
                        at = weight_of(token)
                    if at:
                        sums[k] += weights[at]
            yield pd.DataFrame(chain.probabilities(sums), columns=chain.names)

    return run(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """(doc_id, toxic, p_<category> ...) of every row."""
    chain = train(docs, labels, CATEGORIES, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col), chain, docs.sparkSession).alias("p"))
    return scored.select(
        "doc_id", (F.col("p.toxic") >= limit).alias("toxic"), *[F.col(f"p.{n}").alias(f"p_{n}") for n in CATEGORIES]
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows of `docs` that are not judged toxic."""
    chain = train(docs, labels, CATEGORIES, id_col, text_col)
    row = packed(docs, "row")
    judged = row.withColumn("p", score(F.col(f"row.`{text_col}`"), chain, docs.sparkSession)).where(F.col("p.toxic") < limit)
    return unpacked(judged, "row", {}).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
