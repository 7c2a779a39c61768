"""The corpus pipeline: five stages over ``documents``, each written and read again before the next.

Language ID drops documents whose language can't be told, the n-gram Jaccard
join keeps one document of each group of near-duplicates, decontamination drops
documents that hold a passage of ``benchmark``, the secret scan masks what it
finds, and packing returns the pieces of the training sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import decontaminate, jaccard, language, packing, secrets
from pricelens.llm.common import table, tokenizer_path
from pricelens.session import ensure_checkpoint_dir, small_batches


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return language.keep_known(docs, language.train(language.learnable(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", pack),
]

#: Trained language models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage's rows are a Parquet table in the shared folder."""
    root = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
