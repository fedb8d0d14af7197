"""Operators for preparing language-model training data, on Spark DataFrames.

Nothing outside this subpackage imports it.  ``metassoc.llm.queries`` registers one query per operator.
"""
