"""Registered queries of the corpus operators, and their oracles."""

from __future__ import annotations

import corpus_pipeline
from barloom.llm import (decontamination, jaccard_join, language_kernel, merkle_audit, packing, periodic_runs, pii,
                         pivot_simhash, quality_cnn, scaled_sketch, token_alignment, tool_linking, toxicity_fm)

QUERIES = {
    "op1_toxicity_fm": toxicity_fm.query,
    "op2_language_kernel": language_kernel.query,
    "op3_bin_slack_packing": packing.query,
    "op4_decontamination": decontamination.query,
    "op5_quality_cnn": quality_cnn.query,
    "op6_tool_linking": tool_linking.query,
    "op7_scaled_sketch": scaled_sketch.query,
    "op8_pii_disclosure": pii.query,
    "op9_merkle_audit": merkle_audit.query,
    "op10_jaccard_join": jaccard_join.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_pivot_simhash": pivot_simhash.query,
    "op13_token_alignment": token_alignment.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op8_pii_disclosure": pii.ORACLE_SQL,
    "op4_decontamination": decontamination.ORACLE_SQL,
    "op9_merkle_audit": merkle_audit.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.ORACLE_SQL,
}
