"""The queries of this subpackage, by registered name, and the SQL of those that SQL can express."""

from __future__ import annotations

from claimlens.llm.chat import op10_chat_formatting
from claimlens.llm.chunks import op9_substring_dedup
from claimlens.llm.dac import op4_token_id_output
from claimlens.llm.decontaminate import op2_benchmark_decontamination
from claimlens.llm.langid import op1_language_id
from claimlens.llm.merkle import OP13_SQL, op13_merkle_manifest
from claimlens.llm.mixing import op3_source_mixing
from claimlens.llm.ordermin import op12_document_fingerprints
from claimlens.llm.simhash import op5_simhash_near_dedup
from claimlens.llm.tokens import op7_token_counts
from claimlens.llm.topk import OP8_SQL, op8_exact_top_k
from claimlens.llm.toxicity import op6_toxicity
from claimlens.llm.variants import OP11_SQL, op11_spelling_variants

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_source_mixing": op3_source_mixing,
    "op4_token_id_output": op4_token_id_output,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {"op8_exact_top_k": OP8_SQL, "op11_spelling_variants": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
