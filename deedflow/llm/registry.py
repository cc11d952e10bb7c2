"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import chat_format, collocations, decontaminate, fuzzy_hash, jaccard_join, lang_id, packing, pii, quality, resample, secrets, topk, url_filter

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_quality": quality.op1_quality,
    "op10_pii": pii.op10_pii,
    "op11_collocations": collocations.op11_collocations,
    "op12_importance_resampling": resample.op12_importance_resampling,
    "op13_fingerprints": fuzzy_hash.op13_fingerprints,
    "op2_packing": packing.op2_packing,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_language_id": lang_id.op4_language_id,
    "op5_topk": topk.op5_topk,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_secret_scan": secrets.op9_secret_scan,
}
ORACLES = {
    "op3_jaccard_join": jaccard_join.SQL,
    "op5_topk": topk.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op6_chat_format": chat_format.SQL,
    "op8_url_filter": url_filter.SQL,
    "op11_collocations": collocations.SQL,
    "op12_importance_resampling": resample.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
