"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from panelcast.llm import (q01_url_filter, q02_ngram_join, q03_bpe, q04_vector_dedup, q05_ann, q06_token_files,
                            q07_packing, q08_line_dedup, q09_quality, q10_chat, q11_periodic_runs,
                            q12_html, q13_importance)

QUERIES = {
    "op1_url_filter": q01_url_filter.op1_url_filter,
    "op2_ngram_join": q02_ngram_join.op2_ngram_join,
    "op3_bpe_roundtrip": q03_bpe.op3_bpe_roundtrip,
    "op4_nn_descent": q04_vector_dedup.op4_nn_descent,
    "op5_multi_index": q05_ann.op5_multi_index,
    "op6_token_files": q06_token_files.op6_token_files,
    "op7_packing": q07_packing.op7_packing,
    "op8_line_dedup": q08_line_dedup.op8_line_dedup,
    "op9_quality_vote": q09_quality.op9_quality_vote,
    "op10_chat_format": q10_chat.op10_chat_format,
    "op11_periodic_runs": q11_periodic_runs.op11_periodic_runs,
    "op12_wrapper_induction": q12_html.op12_wrapper_induction,
    "op13_importance_resampling": q13_importance.op13_importance_resampling,
}

ORACLES = {
    "op1_url_filter": q01_url_filter.SQL,
    "op2_ngram_join": q02_ngram_join.SQL,
    "op4_nn_descent": q04_vector_dedup.SQL,
    "op8_line_dedup": q08_line_dedup.SQL,
    "op10_chat_format": q10_chat.SQL,
}
