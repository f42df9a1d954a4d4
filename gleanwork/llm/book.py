"""The queries of the operators: name to (query, SQL or None)."""

from gleanwork.llm import (
    bloom_lm,
    divergence,
    exact_dedup,
    fingerprints,
    mixing,
    ngram_join,
    packing,
    page_text,
    quality,
    quotation,
    repeats,
    toxicity,
    whitening,
)

MODULES = (
    packing, toxicity, exact_dedup, fingerprints, mixing, page_text, quotation, quality, ngram_join, bloom_lm,
    repeats, whitening, divergence,
)

BOOK = {name: pair for module in MODULES for name, pair in module.BOOK.items()}
