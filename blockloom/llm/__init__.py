"""Operators that prepare training data: one module each, and their queries.

Nothing else in the library imports this package.
"""
