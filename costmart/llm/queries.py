"""Registered queries of this package, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from costmart.llm import decontam, hardneg, lm, packing, rans, rules, runs, secrets, simhash, substring, toxicity, unigram, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontam.query,
    "op2_warc": warc.query,
    "op3_packing": packing.query,
    "op4_secrets": secrets.query,
    "op5_quality_rules": rules.query,
    "op6_substring_dedup": substring.query,
    "op7_toxicity": toxicity.query,
    "op8_token_counts": unigram.query,
    "op9_simhash": simhash.query,
    "op10_rans": rans.query,
    "op11_hard_negatives": hardneg.query,
    "op12_periodic_runs": runs.query,
    "op13_lm_scoring": lm.query,
    "pipeline": corpus_pipeline.run,
}

#: The others need a fitted model, XXH64, a tokenizer or an order of packing, which SQL doesn't have;
#: they are tested against brute force.
ORACLES: dict[str, str] = {
    "op1_decontamination": decontam.ORACLE,
    "op2_warc": warc.ORACLE,
    "op6_substring_dedup": substring.ORACLE,
    "op11_hard_negatives": hardneg.ORACLE,
    "op12_periodic_runs": runs.ORACLE,
}
