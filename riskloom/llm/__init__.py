"""Operators for preparing training text: formatting, mixing, deduplication, filtering, encoding, sharding.

Nothing else in the library imports this package.
"""
