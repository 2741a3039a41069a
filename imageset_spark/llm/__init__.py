"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage. Every operator takes and
returns DataFrames; ``queries.py`` applies them to the given tables.
"""
