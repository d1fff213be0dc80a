"""Registered queries of this subpackage, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import (
    centroid_clusters,
    decontamination,
    language_id,
    language_model,
    line_dedup,
    near_duplicates,
    packing,
    quality_rules,
    repeated_bytes,
    repeated_words,
    token_alignment,
    token_files,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_token_files": token_files.op2_token_files,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_near_duplicates": near_duplicates.op4_near_duplicates,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_repeated_bytes": repeated_bytes.op6_repeated_bytes,
    "op7_language_model": language_model.op7_language_model,
    "op8_packing": packing.op8_packing,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_repeated_words": repeated_words.op11_repeated_words,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_centroid_clusters": centroid_clusters.op13_centroid_clusters,
}
ORACLES: dict[str, str] = {
    "op4_near_duplicates": near_duplicates.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op10_decontamination": decontamination.SQL,
    "op11_repeated_words": repeated_words.SQL,
    "op13_centroid_clusters": centroid_clusters.SQL,
}
