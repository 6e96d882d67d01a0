"""Operators of a training-data pipeline, and their registered queries."""

from . import chat, decontaminate, jaccard, langid, licence, lm, negatives, neighbours, pack, quality, shard, urls, whiten

QUERIES = {
    "op1_chat_format": chat.op1,
    "op2_hilbert_shard": shard.op2,
    "op3_nnls_pack": pack.op3,
    "op4_licence_scan": licence.op4,
    "op5_url_filter": urls.op5,
    "op6_quality_rules": quality.op6,
    "op7_ngram_jaccard": jaccard.op7,
    "op8_decontaminate": decontaminate.op8,
    "op9_language_id": langid.op9,
    "op10_masked_lm": lm.op10,
    "op11_collision_ann": neighbours.op11,
    "op12_hard_negatives": negatives.op12,
    "op13_qdwh_whiten": whiten.op13,
}
SQL = {
    "op1_chat_format": chat.SQL1,
    "op4_licence_scan": licence.SQL4,
    "op5_url_filter": urls.SQL5,
    "op7_ngram_jaccard": jaccard.SQL7,
    "op8_decontaminate": decontaminate.SQL8,
    "op12_hard_negatives": negatives.SQL12,
}
