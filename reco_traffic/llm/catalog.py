"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import ann_block, best_fit_packing, embedding_dedup, license_scan, metric_tree_codes, minhash_dedup, quality_pu, run_length_dedup, sampled_shards, sentence_spans, source_mix, target_resampling, warc_bundles

QUERIES = {
    "op1_license_scan": license_scan.query,
    "op2_ann_block": ann_block.query,
    "op3_best_fit_packing": best_fit_packing.query,
    "op4_quality_pu": quality_pu.query,
    "op5_warc_bundles": warc_bundles.query,
    "op6_embedding_dedup": embedding_dedup.query,
    "op7_minhash_dedup": minhash_dedup.query,
    "op8_source_mix": source_mix.query,
    "op9_sentence_spans": sentence_spans.query,
    "op10_run_length_dedup": run_length_dedup.query,
    "op11_sampled_shards": sampled_shards.query,
    "op12_target_resampling": target_resampling.query,
    "op13_metric_tree_codes": metric_tree_codes.query,
}

ORACLES = {
    "op5_warc_bundles": warc_bundles.ORACLE,
    "op6_embedding_dedup": embedding_dedup.ORACLE,
    "op7_minhash_dedup": minhash_dedup.ORACLE,
    "op8_source_mix": source_mix.ORACLE,
    "op13_metric_tree_codes": metric_tree_codes.ORACLE,
}
