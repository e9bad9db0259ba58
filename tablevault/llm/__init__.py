"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. Queries and their SQL are
in ``queries.py``; every operator module can be used on its own.
"""
