"""Structured Streaming entry points.

Every other operator takes finished frames.  The only
streaming use here is to feed micro-batches of *queries* through the same batch retrieval
operators against a written index (``foreachBatch``), with an idempotent sink keyed by the
micro-batch id so a retried batch overwrites, never duplicates.
"""

from .queries import score_query_stream  # noqa: F401
