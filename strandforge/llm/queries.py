"""The queries opN_<name> and, where SQL can express them, their oracles."""

from __future__ import annotations

from . import bin_completion, decontamination, language_model, line_dedup, name_join, near_dedup, packing, quality_classifier, quality_rules, substring_dedup, toxicity, url_rules, vector_codes

_ALL = {
    "op1_decontamination": decontamination,
    "op2_substring_dedup": substring_dedup,
    "op3_near_dedup": near_dedup,
    "op4_language_model": language_model,
    "op5_toxicity": toxicity,
    "op6_quality_rules": quality_rules,
    "op7_line_dedup": line_dedup,
    "op8_quality_classifier": quality_classifier,
    "op9_url_rules": url_rules,
    "op10_packing": packing,
    "op11_vector_codes": vector_codes,
    "op12_bin_completion": bin_completion,
    "op13_name_join": name_join,
}


def queries():
    return {k: m.query for k, m in _ALL.items()}


def oracle_sql():
    return {k: m.ORACLE_SQL for k, m in _ALL.items() if m.ORACLE_SQL}
