"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from tripflow.llm import (
    chat_format,
    decontamination,
    divergence_audit,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    near_dedup,
    ngram_model,
    periodic_runs,
    secret_scan,
    token_counts,
    url_filter,
)

_JOBS = (
    ngram_model.op7_lm_scoring,
    token_counts.op2_token_counts,
    decontamination.op1_decontamination,
    near_dedup.op9_near_dedup,
    language_id.op6_language_id,
    secret_scan.op3_secret_scan,
    license_scan.op5_license_scan,
    mixing.op4_mixing,
    exact_dedup.op10_exact_dedup,
    chat_format.op8_chat_format,
    periodic_runs.op11_periodic_runs,
    url_filter.op12_url_filter,
    divergence_audit.op13_divergence_audit,
)

QUERIES = {job.__name__: job for job in _JOBS}
SQL = exact_dedup.SQL | chat_format.SQL | mixing.SQL | near_dedup.SQL | periodic_runs.SQL | url_filter.SQL | divergence_audit.SQL
