"""Training-data operators: quality, filtering, deduplication, tokenisation, scoring and packing.

Self-contained: nothing else in the library imports this subpackage.
"""
