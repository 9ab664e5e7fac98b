"""Documents from raw to tokenized: five stages, each written and read again as the next one's input.

The first four keep the columns of the documents and drop rows: toxic ones, exact copies but
one, near copies but one, and those that hold a benchmark item. The last returns each
document's token count and the hashes of its ids and of the text that they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapmart.llm.common import table, written
from snapmart.llm.decontamination import without_contaminated
from snapmart.llm.exact_dedup import without_exact_duplicates
from snapmart.llm.piece_encoding import default_model, digests, encode_documents
from snapmart.llm.simhash import first_of_each_class
from snapmart.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(encode_documents(docs, default_model()))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]

#: Classifiers, hash exchanges and tokenizers have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
