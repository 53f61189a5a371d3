"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ann, centroids, conversations, embdedup, licenses, lm, mixing, neardup, packing, pii, quality, sharding, topk
from .oracle import ORACLE_SQL

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_packing": packing.op2_packing,
    "op3_mixing": mixing.op3_mixing,
    "op4_sharding": sharding.op4_sharding,
    "op5_topk": topk.op5_topk,
    "op6_quality": quality.op6_quality,
    "op7_lm_score": lm.op7_lm_score,
    "op8_near_dedup": neardup.op8_near_dedup,
    "op9_pii": pii.op9_pii,
    "op10_ann": ann.op10_ann,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_centroids": centroids.op12_centroids,
    "op13_embedding_dedup": embdedup.op13_embedding_dedup,
}

__all__ = ["QUERIES", "ORACLE_SQL"]
