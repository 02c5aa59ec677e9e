"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Each operator takes and returns
DataFrames; ``queries`` registers one query per operator.
"""
