"""Queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import (
    chat_collapse, language_id, lexical_search, merkle, mixing, multiset_hash, packing, quality_votes, simhash, suffix_dedup, suffix_tree,
    toxic_segments, url_rules,
)


def pipeline(spark, sf_dir: str):
    """All stages of corpus_pipeline.py over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_systematic_mix": mixing.op1_systematic_mix,
    "op2_suffix_tree": suffix_tree.op2_suffix_tree,
    "op3_multiset_hash": multiset_hash.op3_multiset_hash,
    "op4_quality_votes": quality_votes.op4_quality_votes,
    "op5_simhash": simhash.op5_simhash,
    "op6_vector_packing": packing.op6_vector_packing,
    "op7_url_rules": url_rules.op7_url_rules,
    "op8_toxic_segments": toxic_segments.op8_toxic_segments,
    "op9_language_id": language_id.op9_language_id,
    "op10_chat_collapse": chat_collapse.op10_chat_collapse,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
    "pipeline": pipeline,
}

ORACLES = {
    "op1_systematic_mix": mixing.SQL,
    "op3_multiset_hash": multiset_hash.SQL,
    "op4_quality_votes": quality_votes.SQL,
    "op7_url_rules": url_rules.SQL,
    "op10_chat_collapse": chat_collapse.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
