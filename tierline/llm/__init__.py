"""Operators for preparing training text: deduplication, search, mixing, packing, scoring.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to it)
imports it; the library works without it.
"""
