"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from strandwise.llm import ann, chat, exact_dedup, language, mixing, packing, quality, simhash, substring_dedup, token_counts, trie, url_filter, whitening

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_nearest": ann.op4_nearest,
    "op5_language": language.op5_language,
    "op6_packing": packing.op6_packing,
    "op7_quality": quality.op7_quality,
    "op8_chat": chat.op8_chat,
    "op9_simhash": simhash.op9_simhash,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_whitening": whitening.op11_whitening,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_token_counts": token_counts.op13_token_counts,
}
SQL = {"op1_exact_dedup": exact_dedup.OP1_SQL, "op3_url_filter": url_filter.OP3_SQL, "op12_prefix_trie": trie.OP12_SQL}
