"""Queries of this subpackage and, where SQL can express them, their SQL."""

from functools import wraps

from .chat import OP9_SQL, op9_chat_formatting
from .common import ship
from .fingerprints import op5_document_fingerprints
from .lines import OP8_SQL, op8_line_dedup
from .packing import op6_best_fit_packing
from .pieces import op4_sentencepiece
from .similar import OP3_SQL, op3_ngram_jaccard
from .substrings import OP7_SQL, op7_substring_dedup
from .topk import OP2_SQL, op2_exact_topk
from .toxicity import op1_toxicity
from .urls import op10_url_filter


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_topk": op2_exact_topk,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_url_filter": op10_url_filter,
}
QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}
ORACLE_SQL = {"op3_ngram_jaccard": OP3_SQL, "op7_substring_dedup": OP7_SQL, "op2_exact_topk": OP2_SQL, "op8_line_dedup": OP8_SQL, "op9_chat_formatting": OP9_SQL}
