"""Registry of the training-data queries and their SQL twins."""

from __future__ import annotations

from pathkin.llm import (
    ann, bsi, licenses, mixing, neardup, negatives, packing, pii, quality, ranked, secrets, toxicity, transducer,
)

QUERIES = {
    "op1_bit_sliced_topk": bsi.op1_bit_sliced_topk,
    "op2_secret_ownership": secrets.op2_secret_ownership,
    "op3_subsequence_toxicity": toxicity.op3_subsequence_toxicity,
    "op4_rule_ensemble": quality.op4_rule_ensemble,
    "op5_adaptive_dimension_scan": ann.op5_adaptive_dimension_scan,
    "op6_consistent_weighted_dedup": neardup.op6_consistent_weighted_dedup,
    "op7_patience_licenses": licenses.op7_patience_licenses,
    "op8_cost_balanced_packing": packing.op8_cost_balanced_packing,
    "op9_transducer_bpe": transducer.op9_transducer_bpe,
    "op10_boosted_pii": pii.op10_boosted_pii,
    "op11_pivotal_mix": mixing.op11_pivotal_mix,
    "op12_mask_search": ranked.op12_mask_search,
    "op13_residue_negatives": negatives.op13_residue_negatives,
}

SQL = {
    "op1_bit_sliced_topk": bsi.OP1_SQL,
    "op12_mask_search": ranked.OP12_SQL,
    "op13_residue_negatives": negatives.OP13_SQL,
}
