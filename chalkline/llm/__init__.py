"""Operators for large training-data pipelines.

Each module holds one operator with a general interface (column names and
parameters are arguments); ``queries`` derives the registered ``opN_*`` digests
from them.  Nothing outside this subpackage imports it.
"""
