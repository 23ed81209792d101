"""Training-data operators: scoring, formatting, deduplication, filtering, packing.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
