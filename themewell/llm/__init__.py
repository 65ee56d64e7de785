"""Operators for the preparation of training data, one module each.

Nothing else in the library imports this subpackage. Queries and their SQL are
in ``queries.py``.
"""
