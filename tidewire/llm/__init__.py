"""Operators for preparing training text at scale. Nothing else in the library imports this subpackage.

Every operator takes and returns DataFrames and keeps columns it does not know. Texts may be null (treated as empty),
empty or very long; tables may be empty; a column with the name of a result is replaced.
"""
