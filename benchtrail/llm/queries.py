"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from benchtrail.llm import (angular_negatives, collision_search, conversation_repair, jaccard_join, kd_search, language_id, mixing, packing, quality_model, quality_rules,
                            run_index, secret_scan, sharding)

QUERIES = {f.__name__: f for f in (
    jaccard_join.op1_segment_join,
    run_index.op2_run_index_repeats,
    quality_rules.op3_compression_bands,
    mixing.op4_hash_threshold_mix,
    collision_search.op5_collision_counting,
    quality_model.op6_boosted_statistics,
    packing.op7_best_fit_packing,
    sharding.op8_byte_prefix_shards,
    language_id.op9_family_then_pairs,
    secret_scan.op10_secret_scan,
    conversation_repair.op11_interval_repair,
    angular_negatives.op12_angular_negatives,
    kd_search.op13_kd_search,
)}
ORACLE = {
    "op4_hash_threshold_mix": mixing.OP4_SQL,
    "op11_interval_repair": conversation_repair.OP11_SQL,
    "op12_angular_negatives": angular_negatives.OP12_SQL,
    "op13_kd_search": kd_search.OP13_SQL,
}
