"""Operators for building training corpora: quality, deduplication, mixing, encoding, search, archives.

Each module holds one operator with a general interface; ``queries`` registers one thin
query per operator. Nothing outside this package imports it.
"""
