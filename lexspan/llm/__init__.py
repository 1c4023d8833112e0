"""Operators that prepare text for training: deduplication, tagging, mixing, sharding and packing.

Nothing outside this folder imports it. Each operator is a function over DataFrames with
a general interface; `queries` derives from it the fixed digests that are checked.
"""
