"""The queries of the numbered operators by name."""

from __future__ import annotations

from docflow.llm import (
    alignment,
    fingerprints,
    importance,
    jaccard_join,
    language,
    merge_dropout,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    substrings,
    token_counts,
)

QUERIES = {
    "op1_weighted_samples": fingerprints.op1_weighted_samples,
    "op2_bin_completion": packing.op2_bin_completion,
    "op3_adaptive_rules": quality_rules.op3_adaptive_rules,
    "op4_viterbi_spans": language.op4_viterbi_spans,
    "op5_pivot_regions": jaccard_join.op5_pivot_regions,
    "op6_relative_lempel_ziv": substrings.op6_relative_lempel_ziv,
    "op7_rendezvous": sharding.op7_rendezvous,
    "op8_merge_dropout": merge_dropout.op8_merge_dropout,
    "op9_bradley_terry": quality_classifier.op9_bradley_terry,
    "op10_count_viterbi": token_counts.op10_count_viterbi,
    "op11_aho_corasick_resampling": importance.op11_aho_corasick_resampling,
    "op12_one_permutation_minhash": minhash.op12_one_permutation_minhash,
    "op13_inverted_bitmaps": alignment.op13_inverted_bitmaps,
}
