"""Training-data operators: tokenisation, filtering, deduplication, packing and search.

Nothing outside this subpackage imports it (except the entry modules at the repository
top), so it can be removed as a whole.
"""
