"""The llm queries and their SQL, by name; ``__spark_entry__`` adds them when this subpackage can be imported."""

from __future__ import annotations

from recengine.llm import chat_format, ctw, decontaminate, fill_in_middle, html_extract, language_id, minhash_join, mixing, ngram_join, quality, substring_dedup, token_output, vector_codes

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_token_output": token_output.op3_token_output,
    "op4_lm_scores": ctw.op4_lm_scores,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_minhash_join": minhash_join.op11_minhash_join,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLE = {
    "op2_ngram_join": ngram_join.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op7_substring_dedup": substring_dedup.OP7_SQL,
    "op8_chat_format": chat_format.OP8_SQL,
    "op10_mix_sources": mixing.OP10_SQL,
    "op11_minhash_join": minhash_join.OP11_SQL,
    "op12_fill_in_middle": fill_in_middle.OP12_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
