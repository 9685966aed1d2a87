"""Column -> Column functions (no Python UDFs): tokenisers, text transforms, LTR features, vectors."""

from .text import (  # noqa: F401
    PUNCTUATION,
    bigrams,
    normalize_answer,
    remove_punct,
    remove_stopwords,
    resolve_tokenizer,
    run_ends,
    run_lengths,
    suffix_stem,
    term_counts,
    tok_alnum,
    tok_chain,
    tok_simple,
    tok_whitespace,
)
