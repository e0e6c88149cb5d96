"""The operators as queries over the driver tables: name -> (query, SQL or None)."""

from __future__ import annotations

import corpus_pipeline
from truerow.llm import class_lm, conversation_repair, exact_dedup, language_id, minmax_dedup, packing, quality_rules, resampling
from truerow.llm import segmentations, sharding, suffix_dedup, toxicity, url_cascade

QUERIES = {
    "op1_suffix_dedup": (suffix_dedup.op1_suffix_dedup, None),
    "op2_sentencepiece_samples": (segmentations.op2_sentencepiece_samples, None),
    "op3_class_lm": (class_lm.op3_class_lm, None),
    "op4_quality_rules": (quality_rules.op4_quality_rules, quality_rules.SQL),
    "op5_minmax_dedup": (minmax_dedup.op5_minmax_dedup, minmax_dedup.SQL),
    "op6_url_cascade": (url_cascade.op6_url_cascade, url_cascade.SQL),
    "op7_rendezvous_shards": (sharding.op7_rendezvous_shards, None),
    "op8_tree_dedup": (exact_dedup.op8_tree_dedup, exact_dedup.SQL),
    "op9_hilbert_packing": (packing.op9_hilbert_packing, None),
    "op10_toxic_segments": (toxicity.op10_toxic_segments, None),
    "op11_conversation_repair": (conversation_repair.op11_conversation_repair, None),
    "op12_language_id": (language_id.op12_language_id, None),
    "op13_target_resampling": (resampling.op13_target_resampling, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
