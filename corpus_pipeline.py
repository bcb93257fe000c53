"""Training-text pipeline over `documents`: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and works on all that the one before kept. Quality rules drop
documents, near-duplicates keep one of each group (five-word shingles, similarity 0.8 or more), repeated
passages are cut out, documents that hold a benchmark passage go, and what is left is encoded and decoded.

Defined cases, for all stages: a document is known by doc_id and text, so rows without an id or with the id
of another text are judged by themselves; null and empty texts fail the quality rules; of rows that repeat id
and text one stays, as of near copies, where the least doc_id stays and one without an id only if none has
one; long texts are read whole; an empty table gives an empty result with the same columns; other columns,
whatever their names, go through all stages but the last, which returns doc_id, lang, source and the
tokens' count and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palaver.llm import bpe, decontaminate, quality, simhash, suffixdedup
from palaver.llm.common import scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.cleaned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("decontamination", decontamination), ("encoding", encoding)]
#: Fingerprints, repeated byte strings and token ids are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark)
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
