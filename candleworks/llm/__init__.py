"""Operators for preparing training text: scans, classifiers, deduplication, joins, tokens.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; :mod:`candleworks.llm.queries` registers one query per operator.
"""
