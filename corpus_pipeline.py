"""A corpus pipeline over ``documents``: toxicity, near-duplicates, secrets, source mix, token ids.

``run`` applies the stages in order, each written as Parquet below the shared folder and read again as
the next one's input; the folder of a stage goes when the next one is written. All stages but the last return the
columns of ``documents``. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import mixing, pieces, secret_scan, simhash, toxicity
from riskloom.llm.common import discard, table
from riskloom.session import work_dir


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on labelled rows that are not held out, rejects go.

    Null and empty texts are kept unless the model rejects what has no words at all.
    """
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked and n_chars following."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is left out, or stays up to three times."""
    return mixing.take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids in a column ``ids``, with underscores added if the name is taken."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("pieces", encoded),
]

#: Compression, suffix arrays and the trie join have no SQL; the tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
