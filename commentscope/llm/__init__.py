"""Operators of a training-data pipeline: filtering, deduplication, scans and packing.

Nothing else in the library imports this subpackage.
"""
