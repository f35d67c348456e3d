"""Operators of a training-data pipeline over ``documents``-like tables.

Nothing outside this subpackage imports it. :mod:`mentions.llm.queries`
registers one query per operator.
"""
