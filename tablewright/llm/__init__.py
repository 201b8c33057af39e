"""Operators that prepare text corpora for training language models; nothing else in the library imports them."""

from tablewright.llm import (  # noqa: F401  (each import registers its query)
    bpe, chat, decontamination, lexical, neardup, negatives, neighbours, packing, quality, secrets, substrings, toxicity, vectordup,
)
from tablewright.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
