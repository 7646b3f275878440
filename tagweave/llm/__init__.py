"""Operators of a training-data pipeline (mixing, sharding, deduplication, filters, ...).

Nothing else in the library imports this subpackage.
"""
