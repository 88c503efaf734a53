"""Operators for training-data pipelines (packing, deduplication, rules, scoring, archives).

Nothing else in the library imports this package. Each operator lives in its own
module with a general ``DataFrame -> DataFrame`` interface; ``queries`` holds the
thin registered queries and their SQL.
"""
