"""Operators of a training-data pipeline (sharding, deduplication, scoring, extraction, packing).

Nothing else in the library imports this subpackage.
"""
