"""Operators for building training corpora: scans, scoring, deduplication, mixing, sharding.

Nothing outside this package imports it. Every operator takes and returns DataFrames, keeps
to the columns it names and ignores all others.
"""
