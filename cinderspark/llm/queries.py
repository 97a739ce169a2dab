"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from cinderspark.llm import bpe, decontaminate, jaccard_join, language, line_dedup, neighbours, secrets, suffix_tree, token_store, toxicity

QUERIES = {
    "op1_jaccard": jaccard_join.op1_jaccard,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_neighbours": neighbours.op3_neighbours,
    "op4_bpe": bpe.op4_bpe,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_suffix_tree": suffix_tree.op7_suffix_tree,
    "op8_token_files": token_store.op8_token_files,
    "op9_secrets": secrets.op9_secrets,
    "op10_language": language.op10_language,
}
SQL = {
    "op1_jaccard": jaccard_join.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
}
