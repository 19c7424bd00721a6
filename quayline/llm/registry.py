"""The queries of this package and, where SQL can express one, its SQL."""

from quayline.llm import (
    collocations, exact, lm, mixing, neighbours, packing, quality, secrets, sharding, shingles, urls, whitening, wordpieces)

QUERIES = {
    "op1_permutation_shards": sharding.op1_permutation_shards,
    "op2_tree_merge_dedup": exact.op2_tree_merge_dedup,
    "op3_soft_membership_mixing": mixing.op3_soft_membership_mixing,
    "op4_context_mixing_lm": lm.op4_context_mixing_lm,
    "op5_ownership_secrets": secrets.op5_ownership_secrets,
    "op6_positive_unlabelled_quality": quality.op6_positive_unlabelled_quality,
    "op7_hash_prefix_urls": urls.op7_hash_prefix_urls,
    "op8_linear_grouping_packing": packing.op8_linear_grouping_packing,
    "op9_signature_tree_join": shingles.op9_signature_tree_join,
    "op10_hash_prefix_forest": neighbours.op10_hash_prefix_forest,
    "op11_block_whitening": whitening.op11_block_whitening,
    "op12_piece_backtracking": wordpieces.op12_piece_backtracking,
    "op13_prefix_free_collocations": collocations.op13_prefix_free_collocations,
}

ORACLES = {
    "op2_tree_merge_dedup": exact.OP2_SQL,
    "op7_hash_prefix_urls": urls.OP7_SQL,
    "op9_signature_tree_join": shingles.OP9_SQL,
    "op13_prefix_free_collocations": collocations.OP13_SQL,
}
