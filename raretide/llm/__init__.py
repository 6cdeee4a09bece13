"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing else in the library imports this subpackage.  Each ``opN`` module holds one operator with a
general interface and the thin registered query that derives the digest columns from it.
"""
