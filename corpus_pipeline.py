"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import bpe, decontaminate, exact_dedup, langid, ngram_join
from pricelake.llm.common import share_code, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language id, learned from the rows outside the held-out fold: documents of unknown language go."""
    share_code(spark)
    model = langid.fit(docs.where(langid.fold_of("doc_id", 5) != 0))
    return langid.keep_identified(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    share_code(spark)
    return exact_dedup.drop_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar texts, the row with the smallest doc_id stays."""
    share_code(spark)
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    share_code(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    share_code(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark", benchmark), ("tokens", tokens)]

#: The stages are a trained model, min-hashes and byte merges, which SQL can't express; tests compare them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
