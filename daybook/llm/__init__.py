"""Operators for preparing training data: deduplication, filtering, packing, sharding.

Every operator takes DataFrames and returns DataFrames; the thin queries that run
them over the given tables are in :mod:`daybook.llm.queries`.
"""
