"""A corpus pipeline of stages, each calling one corpus operator.

Each stage works on all rows that its predecessor kept. All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import langid, quality, simhash
from lodestar.llm.common import free_name, read_table, staged, word_count
from lodestar.llm.mixing import curriculum, training_order
from lodestar.llm.packing import pack_documents

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in known languages, however many each has; the columns, ``lang`` too, stay as they are."""
    found = free_name(docs, "_found")
    rows = docs.withColumn(found, langid.language(F.col("text"), langid.fit(docs)))
    return rows.where(F.col(f"{found}.lang") != langid.UNKNOWN).select(*docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier scores at or above the operator's cut."""
    score = free_name(docs, "_score")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, score=score).where(F.col(score) >= quality.CUT).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return training_order(curriculum(docs, word_count(F.col("text"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None  # trained models and hashes that SQL lacks


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{k}")
    return docs
