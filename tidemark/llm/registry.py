"""The corpus queries by name, and DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm.bpe import op7_prefix_bpe
from tidemark.llm.embeddings import op1_pivot_permutation
from tidemark.llm.language import op6_ppm_language
from tidemark.llm.line_dedup import OP5_SQL, op5_perfect_hash_lines
from tidemark.llm.mixing import OP8_SQL, op8_poisson_replication
from tidemark.llm.quality_classifier import op2_site_bayes
from tidemark.llm.quality_rules import op10_likelihood_ratio
from tidemark.llm.sharding import op3_external_shuffle
from tidemark.llm.simhash import op4_pivot_simhash
from tidemark.llm.token_files import op9_simple8b

QUERIES = (op1_pivot_permutation, op2_site_bayes, op3_external_shuffle, op4_pivot_simhash, op5_perfect_hash_lines, op6_ppm_language, op7_prefix_bpe, op8_poisson_replication, op9_simple8b, op10_likelihood_ratio)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op5_perfect_hash_lines": OP5_SQL, "op8_poisson_replication": OP8_SQL}
