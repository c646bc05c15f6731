"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from grantweave.llm import (
    bpe, decontaminate, embedding_dedup, lexical_search, line_dedup, lm_scoring, mixing, near_dedup, quality, suffix_dedup,
    toxicity, url_filter, vector_codes,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_lm_scoring": lm_scoring.op5_lm_scoring,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_quality": quality.op8_quality,
    "op9_minhash": near_dedup.op9_minhash,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_mixing": mixing.op13_mixing,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op2_decontamination": decontaminate.OP2_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op11_lexical_search": lexical_search.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
    "op13_mixing": mixing.OP13_SQL,
}
