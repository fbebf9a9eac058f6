"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, html_text, line_dedup, lm, mixing, prefix_trie, quality, simhash, toxicity, url_filter, warc, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_lm_scores": lm.op2_lm_scores,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_simhash_dedup": simhash.op4_simhash_dedup,
    "op5_html_text": html_text.op5_html_text,
    "op6_bpe": bpe.op6_bpe,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_warc_revisit": warc.op8_warc_revisit,
    "op9_quality_outliers": quality.op9_quality_outliers,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE = {
    "op1_mix_sources": mixing.ORACLE,
    "op3_url_filter": url_filter.ORACLE,
    "op8_warc_revisit": warc.ORACLE,
    "op9_quality_outliers": quality.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
}
