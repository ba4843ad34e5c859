"""Training-data operators: sharding, tokens, quality, fingerprints, mixing,
deduplication, URL filters and personal data.

Nothing else in the library imports this subpackage.
"""
