"""Training-data operators: formatting, search, mixing, encoding, deduplication.

Nothing outside this package imports it.
"""
