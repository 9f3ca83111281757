"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tillwork.llm import (
    bpe,
    embeddings,
    fingerprints,
    hard_negatives,
    jaccard,
    language,
    licences,
    merkle,
    packing,
    quality,
    suffix_tree,
    toxicity,
    warc,
)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_suffix_tree": suffix_tree.op2_suffix_tree,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_bpe": bpe.op5_bpe,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_language": language.op7_language,
    "op8_embeddings": embeddings.op8_embeddings,
    "op9_licences": licences.op9_licences,
    "op10_packing": packing.op10_packing,
    "op11_merkle": merkle.op11_merkle,
    "op12_quality": quality.op12_quality,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLE_SQL = {
    "op1_warc": warc.ORACLE_SQL,
    "op11_merkle": merkle.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
