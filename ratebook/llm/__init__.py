"""Operators for preparing training data, and their registered queries.

Nothing else in the library imports this package.
"""
