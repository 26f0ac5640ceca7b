"""Operators of a training-data pipeline over a documents table, one module per operator.

Nothing else in the library imports this subpackage. `catalog` registers one query per operator.
"""
