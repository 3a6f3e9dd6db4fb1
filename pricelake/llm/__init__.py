"""Operators of a training-data pipeline: language id, deduplication, filters, decontamination, archives, tokenizing.

Nothing outside this package imports it; its queries are in :mod:`pricelake.llm.queries`.
"""
