"""From ``documents`` to token ids: the stages of a training corpus, each stored before the next one reads it.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last returns (doc_id, n_tokens, ids).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.llm import bpe, decontaminate, exact_dedup, jaccard_join, langid
from cardloom.llm.common import shared_folder, stored
from cardloom.sources.tables import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of which the model fitted on their labels is not sure enough, go."""
    return langid.keep_known(docs, langid.train(docs))


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of at least 0.8 on five-word shingles connect, the one with the smallest id stays."""
    return jaccard_join.drop_near_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter one, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", no_exact_copies),
    ("jaccard_join", no_near_copies),
    ("decontaminate", no_benchmark),
    ("bpe", token_ids),
]

#: Learned languages and merges by rank cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
