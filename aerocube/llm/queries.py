"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, hard_negatives, html_text, licenses, mixing, near_dup, quality, sentence_pieces, sharding, syncmers, url_filter, whitening

QUERIES = {
    "op1_jump_shards": sharding.op1_jump_shards,
    "op2_syncmers": syncmers.op2_syncmers,
    "op3_chat_format": chat.op3_chat_format,
    "op4_bpe": bpe.op4_bpe,
    "op5_html_text": html_text.op5_html_text,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_host_rules": quality.op7_host_rules,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_url_reputation": url_filter.op9_url_reputation,
    "op10_near_duplicates": near_dup.op10_near_duplicates,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_whitening": whitening.op12_whitening,
    "op13_sentence_pieces": sentence_pieces.op13_sentence_pieces,
}
ORACLE_SQL = {"op3_chat_format": chat.ORACLE, "op7_host_rules": quality.ORACLE, "op9_url_reputation": url_filter.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE}
