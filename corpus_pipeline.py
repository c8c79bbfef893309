"""From raw documents to token ids: quality, repeated lines, near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of ``documents``;
the last returns tokens. The stages are narrow or work on their own shared intermediate tables, and
``run`` writes each stage's result to the shared folder and reads it again, so that a lost executor
costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwork.llm import decontam, jaccard, lines, pieces, quality
from tabwork.llm.common import stored
from tabwork.plans.base import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, quality.train_on_labels(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of the texts, and drops documents of which nothing but blank is left."""
    found = lines.dedup_lines(docs)
    left = found.where((F.col("_n_removed") == 0) | F.rlike("text", F.lit(r"\S")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates."""
    return jaccard.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with benchmark passages."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of ids and decoded text."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", keep_one_of_group),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", tokenize),
]

#: A trained model and a tokenizer are in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
