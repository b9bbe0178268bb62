"""Training-data operators: deduplication, language and quality, extraction, tokens and packing.

Nothing else in the library imports this package.
"""
