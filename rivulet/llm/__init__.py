"""Operators of a training-data pipeline over ``documents`` and ``pages`` tables.

Nothing else in the library imports this subpackage.  Each module holds one operator with its
general interface; ``queries`` registers the thin ``opN_*`` queries and their oracle SQL.
"""
