"""Registered queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from profitgrid.llm import chat_trees, decontaminate, exact_topk, fp_tree, line_dedup, secrets, spelling
from profitgrid.llm.bpe_codec import op10_bpe_codec
from profitgrid.llm.chat_trees import op8_chat_trees, op8_reply_branches
from profitgrid.llm.decontaminate import op3_decontamination, op3_proximity
from profitgrid.llm.exact_topk import op2_exact_topk
from profitgrid.llm.fp_tree import op13_ranked_search
from profitgrid.llm.line_dedup import op5_line_dedup
from profitgrid.llm.ppm import op12_language_id
from profitgrid.llm.secrets import op1_secret_scan
from profitgrid.llm.simhash import op6_simhash
from profitgrid.llm.spelling import op11_spelling_variants
from profitgrid.llm.suffix_dedup import op9_suffix_dedup
from profitgrid.llm.token_prefixes import op7_token_counts
from profitgrid.llm.toxicity import op4_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [
        op1_secret_scan, op2_exact_topk, op3_decontamination, op4_toxicity, op5_line_dedup,
        op6_simhash, op7_token_counts, op8_chat_trees, op9_suffix_dedup, op10_bpe_codec,
        op11_spelling_variants, op12_language_id, op13_ranked_search, op3_proximity, op8_reply_branches,
    ]
    return {q.__name__: q for q in every}


def oracle_sql() -> dict[str, str]:
    """The others have no SQL: fitted models, XXH64, tokenizers, proximity, and byte strings too many for a table."""
    return {
        "op1_secret_scan": secrets.SQL,
        "op2_exact_topk": exact_topk.SQL,
        "op3_decontamination": decontaminate.SQL,
        "op5_line_dedup": line_dedup.SQL,
        "op8_chat_trees": chat_trees.SQL,
        "op8_reply_branches": chat_trees.BRANCHES_SQL,
        "op11_spelling_variants": spelling.SQL,
        "op13_ranked_search": fp_tree.SQL,
    }
