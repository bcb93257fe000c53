"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palaver.llm import bpe, decontaminate, htmltext, langid, ppm, quality, sharding, simhash, suffixdedup, toxicity
from palaver.llm.common import table


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_ppm_scores": ppm.op4_ppm_scores,
        "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
        "op6_language_id": langid.op6_language_id,
        "op7_html_main_text": htmltext.op7_html_main_text,
        "op8_hilbert_sharding": sharding.op8_hilbert_sharding,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_suffix_array_dedup": suffixdedup.op10_suffix_array_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_simhash_near_dedup": simhash.ORACLE,
        "op3_quality_rules": quality.ORACLE,
        "op5_benchmark_decontamination": decontaminate.ORACLE,
        "op8_hilbert_sharding": sharding.ORACLE,
        "op10_suffix_array_dedup": suffixdedup.ORACLE,
    }
