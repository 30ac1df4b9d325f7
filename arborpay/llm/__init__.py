"""Training-data operators: near-dedup, formatting, scoring, search, packing, stores and rollups.

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
