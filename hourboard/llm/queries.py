"""The queries of this subpackage and the SQL of those that SQL can express."""

from hourboard.llm import (
    byte_bpe,
    conversations,
    exact_dedup,
    html_text,
    language_id,
    near_dedup,
    packing,
    quality,
    repeats,
    spelling,
    token_files,
    url_filter,
    vector_join,
)

REGISTRY = {
    "op1_byte_bpe": byte_bpe.op1_byte_bpe,
    "op2_quality": quality.op2_quality,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_html_text": html_text.op5_html_text,
    "op6_packing": packing.op6_packing,
    "op7_vector_join": vector_join.op7_vector_join,
    "op8_token_files": token_files.op8_token_files,
    "op9_language_id": language_id.op9_language_id,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_substring_dedup": repeats.op12_substring_dedup,
    "op13_spelling": spelling.op13_spelling,
}

ORACLE = {"op3_exact_dedup": exact_dedup.SQL, "op12_substring_dedup": repeats.SQL}
