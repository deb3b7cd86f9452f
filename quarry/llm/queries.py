"""Queries of this subpackage, by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import chat_format, collocations, decontaminate, fingerprints, license_scan, lm_scoring, near_dedup, packing, quality, quality_rules, suffix_dedup, token_output, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_token_output": token_output.op5_token_output,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_collocations": collocations.op11_collocations,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_quality_rules": quality_rules.op13_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op8_license_scan": license_scan.OP8_SQL,
    "op9_chat_format": chat_format.OP9_SQL,
    "op11_collocations": collocations.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
