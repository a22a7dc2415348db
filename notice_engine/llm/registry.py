"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from notice_engine.llm import bpe, chat, lm, media, mixing, neardup, quality, substring, topk, warc

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_near_duplicates": neardup.op2_near_duplicates,
    "op3_chat_format": chat.op3_chat_format,
    "op4_lm_score": lm.op4_lm_score,
    "op5_substrings": substring.op5_substrings,
    "op6_topk": topk.op6_topk,
    "op7_media": media.op7_media,
    "op8_bpe": bpe.op8_bpe,
    "op9_warc_fixity": warc.op9_warc_fixity,
    "op10_quality": quality.op10_quality,
}

ORACLE_SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op3_chat_format": chat.OP3_SQL,
    "op5_substrings": substring.OP5_SQL,
    "op6_topk": topk.OP6_SQL,
}
