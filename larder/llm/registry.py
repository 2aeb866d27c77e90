"""Queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from larder.llm import bpe, chat_format, conversation_trie, decontaminate, embedding_dedup, jaccard_join, language_id, lm_score, mixing, secrets, spelling, substrings, warc

QUERIES = {
    "op1_lm_score": lm_score.op1_lm_score,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_warc": warc.op3_warc,
    "op4_mixing": mixing.op4_mixing,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_language_id": language_id.op9_language_id,
    "op10_substring_dedup": substrings.op10_substring_dedup,
    "op11_spelling": spelling.op11_spelling,
    "op12_bpe": bpe.op12_bpe,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}
ORACLE = {
    "op2_decontamination": decontaminate.ORACLE,
    "op3_warc": warc.ORACLE,
    "op6_secret_scan": secrets.ORACLE,
    "op10_substring_dedup": substrings.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
