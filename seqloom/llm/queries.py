"""Registered queries of this package and the SQL they must agree with, where SQL can say it."""

from seqloom.llm import (
    alignment,
    bpe,
    decontaminate,
    exact_dedup,
    language_id,
    ngram_model,
    periodic_runs,
    pii,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_simhash": simhash.op3_simhash,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_bpe": bpe.op6_bpe,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_language_id": language_id.op8_language_id,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_ngram_model": ngram_model.op10_ngram_model,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_exact_dedup": exact_dedup.op13_exact_dedup,
}

ORACLES = {
    "op5_quality_rules": quality_rules.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op11_periodic_runs": periodic_runs.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
