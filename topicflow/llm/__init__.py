"""Operators for training-data pipelines: scans, deduplication, packing, sharding, binary output.

Nothing else in the library imports this subpackage.
"""
