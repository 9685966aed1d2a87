"""Registered query plans (one per inventory row) and their DuckDB oracle SQL.

Importing this package imports every plan module, which fills the registry.
"""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import lexical_q, eval_q, text_q, corpus_q, retrieval_q, fusion_q, analysis_q, ltr_q, qa_q, io_q  # noqa: F401,E402
