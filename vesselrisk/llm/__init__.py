"""Operators of a training-data pipeline: sharding, formatting, dedup, filtering, mixing, scoring.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` derives the fixed
result columns from the operators' outputs.
"""
