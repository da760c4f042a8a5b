"""Operators for preparing training text: scoring, mixing, deduplication,
language identification, search, URL rules and tokenization.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
