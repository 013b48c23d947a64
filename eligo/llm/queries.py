"""Registered queries of this package and their SQL."""

from __future__ import annotations

from eligo.llm import alignment, collocations, decontaminate, lines, mixing, paragraphs, ppm, preference, quality, sharding, simhash, token_counts, token_records

QUERIES = {
    "op1_token_records": token_records.op1_query,
    "op2_source_mixing": mixing.op2_query,
    "op3_simhash": simhash.op3_query,
    "op4_ppm_scores": ppm.op4_query,
    "op5_preference_pairs": preference.op5_query,
    "op6_token_counts": token_counts.op6_query,
    "op7_decontamination": decontaminate.op7_query,
    "op8_paragraph_dedup": paragraphs.op8_query,
    "op9_quality_rules": quality.op9_query,
    "op10_sharding": sharding.op10_query,
    "op11_collocations": collocations.op11_query,
    "op12_token_alignment": alignment.op12_query,
    "op13_line_dedup": lines.op13_query,
}

# The other operators hash, walk or fit in ways SQL cannot express; tests/llm holds them against brute force.
ORACLE: dict[str, str] = {
    "op5_preference_pairs": preference.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_line_dedup": lines.ORACLE,
}
