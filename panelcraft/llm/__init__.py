"""Operators for preparing training data: mixing, near-duplicates, quality, licences, tokens and shards.

Every operator takes and returns DataFrames. Nothing else in the library imports this package.
"""
