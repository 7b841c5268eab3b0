"""Operators for training-data pipelines: counting, scoring, deduplicating, packing, searching.

Nothing else in the package imports this subpackage.  General helpers (shared
work folder, size-checked broadcast) come from the rest of the package.
"""
