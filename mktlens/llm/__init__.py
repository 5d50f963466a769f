"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
thin registered queries, ``oracle.py`` their SQL.
"""
