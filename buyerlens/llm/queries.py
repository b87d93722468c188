"""Registered queries of this subpackage, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from buyerlens.llm import (
    budget_mix, exact_packing, hamming_dedup, merkle_windows, pii_votes, pitman_yor, positional_index, quality_divergence, secret_automaton,
    separator_scan, simple8b, source_audit, template_pages,
)
from buyerlens.session import configure


def _read(spark, sf_dir: str, table: str):
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def _over(table: str, operator):
    return lambda spark, sf_dir: operator(_read(spark, sf_dir, table))


def _pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(configure(spark), sf_dir)


QUERIES = {
    "op1_token_counts": _over("documents", separator_scan.token_counts),
    "op2_near_dedup": _over("documents", hamming_dedup.near_duplicates),
    "op3_decontamination": lambda spark, sf_dir: positional_index.contamination(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")),
    "op4_token_ids": _over("documents", simple8b.encoded),
    "op5_lm_scoring": _over("documents", pitman_yor.scored),
    "op6_html_extraction": _over("pages", template_pages.extracted),
    "op7_quality_rules": _over("documents", quality_divergence.divergence_report),
    "op8_secret_scan": _over("documents", secret_automaton.secret_report),
    "op9_source_mix": _over("documents", budget_mix.mix_report),
    "op10_personal_data": _over("documents", pii_votes.personal_report),
    "op11_merkle_manifest": _over("documents", merkle_windows.manifest_report),
    "op12_exact_packing": _over("documents", exact_packing.packed),
    "op13_source_audit": _over("documents", source_audit.divergence),
    "pipeline": _pipeline,
}

#: The others fit models, fill knapsacks or link transitively; tests hold parts of them against brute force.
ORACLES = {
    "op3_decontamination": positional_index.ORACLE,
    "op11_merkle_manifest": merkle_windows.ORACLE,
    "op13_source_audit": source_audit.ORACLE,
}
