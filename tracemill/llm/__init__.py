"""Training-data operators: deduplication, quality, privacy, tokenisation, archives.

Nothing else in the library imports this subpackage; it may be removed whole.
"""
